"""Importance resampling towards a target distribution.

Words (A-Z lower-cased) and runs of words are hashed into buckets. A bucket's gain is the
logarithm of how much likelier it is among the target's texts than among the documents;
a document's weight is the sum of its features' gains, and Gumbel noise from a digest of its id
turns the order by score into a draw without replacement.

* Bucket counts are arrays inside a task, one row a bucket and task in the shuffle, so a
  frequent word costs no more than a rare one. Gains reach the tasks as one array
  of as many numbers as there are buckets, whatever the corpus holds.
* The k-th best document comes from a distributed quickselect over a written table of
  scores: random rows of the open interval are the pivots, exact counts before, at and
  between them say where the k-th key lies, and the interval narrows until it is a
  pivot. Keys are (score, doc_id, number of the written row), so no two are equal.
* The winners alone are sorted, by ranges, and ranked: a row's rank is its place in its range
  and the sizes of the ranges before it. All others are passed on unsorted.

Rows: a null or empty text has no features and weight 0; a null doc_id counts as empty text in
the digest and comes last among equal scores; repeated rows are scored and drawn each; an empty
table gives no rows, an empty target one smoothed count a bucket; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import LOWER, Flat, flat_slices, tokens_of, written

#: Pivots of a round of the quickselect.
PIVOTS = 31
#: Bytes of a word up to which the crc is taken for all words at once.
SHORT_WORD = 32

_SCORED = "doc_id long, n_words long, n_features long, weight long, score long"


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1).astype(np.uint32)
    return table


_TABLE = _crc_table()


def _step(state: np.ndarray, byte) -> np.ndarray:
    return _TABLE[(state ^ byte) & 0xFF] ^ (state >> np.uint32(8))


def _feed(state: np.ndarray, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Running crc32 states after the bytes of each span."""
    state, sizes = state.copy(), ends - starts
    live, k = np.flatnonzero(sizes <= SHORT_WORD), 0
    while len(live):
        state[live] = _step(state[live], data[starts[live] + k])
        k += 1
        live = live[sizes[live] > k]
    for i in np.flatnonzero(sizes > SHORT_WORD).tolist():
        done = zlib.crc32(data[starts[i] : ends[i]].tobytes(), int(state[i]) ^ 0xFFFFFFFF)
        state[i] = done ^ 0xFFFFFFFF
    return state


def features(flat: Flat, runs: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row and bucket of every feature of a slice, and the number of words of its rows."""
    data, tokens = LOWER[flat.data], tokens_of(flat)
    words = tokens.is_word
    starts, ends, rows = tokens.starts[words], tokens.ends[words], tokens.docs[words]
    state = np.full(len(starts), 0xFFFFFFFF, np.uint32)
    owners, found = [], []
    for length in range(1, min(runs, len(starts)) + 1):
        first = np.flatnonzero(rows[: len(rows) - length + 1] == rows[length - 1 :])
        last = first + length - 1
        before = state[first] if length == 1 else _step(state[first], np.uint32(0x20))
        state[first] = _feed(before, data, starts[last], ends[last])
        owners.append(rows[first])
        found.append((state[first] ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets))
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *owners]), np.concatenate([none, *found]), np.bincount(rows, minlength=len(flat))


def bucket_counts(texts: DataFrame, runs: int, buckets: int, text_column: str = "text") -> np.ndarray:
    """How many features of all texts fall in each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for flat in flat_slices(batch.column(0)):
                total += np.bincount(features(flat, runs, buckets)[1], minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen])], names=["bucket", "n"])

    parts = texts.select(F.col(text_column).cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row a bucket
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    all_s, all_t = float(source.sum() + len(source)), float(target.sum() + len(target))
    pairs = zip(source.tolist(), target.tolist())
    return np.array([math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in pairs], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel variate from the digest of an id, rounded down."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return math.floor(-1000 * math.log(-math.log((int(digest[:8], 16) + 0.5) / 4294967296)))


def score_documents(docs: DataFrame, gains: np.ndarray, runs: int, seed: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, weight, score) of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for flat in flat_slices(batch.column(1)):
                rows, found, words = features(flat, runs, len(gains))
                n = np.bincount(rows, minlength=len(flat))
                ends = np.cumsum(np.bincount(rows, minlength=len(flat)))
                order = np.argsort(rows, kind="stable") if runs > 1 else slice(None)
                running = np.concatenate([[0], np.cumsum(gains[found[order]])])
                weight = running[ends] - running[ends - n]
                own = ids.slice(flat.first, len(flat))
                luck = np.array([noise(i, seed) for i in own.to_pylist()], np.int64)
                columns = [own, words.astype(np.int64), n.astype(np.int64), weight, weight + luck]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=[x.split()[0] for x in _SCORED.split(", ")])

    chosen = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return chosen.mapInArrow(score, _SCORED)


def _key() -> Column:
    """What rows are ordered by: best score, smallest doc_id (null last), written row."""
    return F.struct((-F.col("score")).alias("a"), F.col("doc_id").isNull().alias("b"), F.coalesce("doc_id", F.lit(0)).alias("c"), F.col("row").alias("d"))


def _fixed(key: tuple[int, bool, int, int]) -> Column:
    a, b, c, d = key
    return F.struct(F.lit(a).cast("long").alias("a"), F.lit(b).alias("b"), F.lit(c).cast("long").alias("c"), F.lit(d).cast("long").alias("d"))


def kth_key(keys: DataFrame, n: int, k: int, pivots: int = PIVOTS) -> tuple[int, bool, int, int]:
    """The k-th (from 1) of the n distinct keys in column ``key`` of a written table."""
    if not 1 <= k <= n:
        raise ValueError(f"there is no key {k} of {n}")
    inside, left, turn = keys, k, 0
    low = high = None
    while True:
        if low is not None:
            inside = keys.where(F.col("key") > _fixed(low))
        if high is not None:
            inside = (inside if low is not None else keys).where(F.col("key") < _fixed(high))
        # about 4 x pivots rows by hash, so that a task sends its few and not its best ``pivots``
        luck = F.pmod(F.xxhash64(F.lit(turn), F.col("key.d")), F.lit(1 << 31))
        turn += 1
        drawn = inside.where(luck <= int((1 << 31) * min(1.0, 4 * pivots / n))).orderBy(luck, "key.d").limit(pivots).collect()
        chosen = sorted(tuple(row["key"]) for row in drawn)
        # 2i: between pivots i - 1 and i; 2i + 1: at pivot i
        place = sum(((F.col("key") >= _fixed(p)).cast("int") + (F.col("key") > _fixed(p)).cast("int") for p in chosen), F.lit(0))
        counts = {row["place"]: row["count"] for row in inside.groupBy(place.alias("place")).count().collect()}
        for at in range(2 * len(chosen) + 1):
            if left <= counts.get(at, 0):
                break
            left -= counts.get(at, 0)
        if at % 2:
            return chosen[at // 2]
        low = chosen[at // 2 - 1] if at else low
        high = chosen[at // 2] if at // 2 < len(chosen) else high
        n = counts[at]


def ranked(winners: DataFrame) -> DataFrame:
    """``winners`` (with ``key``) sorted by ranges, with ``rank`` from 1."""
    parts = int(winners.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = [F.col(f"key.{x}") for x in "abcd"]
    ordered = winners.repartitionByRange(parts, *key).sortWithinPartitions(*key).withColumn("place", F.monotonically_increasing_id())
    ordered = written(ordered, "winners")
    part = F.shiftright("place", 33)  # the id is the partition's number, then 33 bits for the row's
    sizes = {r["part"]: r["count"] for r in ordered.groupBy(part.alias("part")).count().collect()}  # a row a partition
    before = np.concatenate([[0], np.cumsum([sizes.get(i, 0) for i in range(max(sizes) + 1)])]).tolist()
    offset = F.element_at(F.lit([int(x) for x in before]), (part + 1).cast("int"))
    return ordered.withColumn("rank", (offset + F.col("place").bitwiseAND((1 << 33) - 1) + 1).cast("long")).drop("place")


def resample(docs: DataFrame, target: DataFrame, percent: int = 10, least_words: int = 20, runs: int = 1, buckets: int = 10_000, seed: int = 2024) -> DataFrame:
    """(doc_id, n_features, weight, score, rank): every document, ranked if it is among the
    ``percent`` hundredths (rounded down) with the highest scores of those with at least
    ``least_words`` words."""
    gains = bucket_gains(bucket_counts(docs, runs, buckets), bucket_counts(target, runs, buckets))
    scored = score_documents(docs, gains, runs, seed).withColumn("row", F.monotonically_increasing_id())
    scored = written(scored, "scored").withColumn("key", _key())
    able = F.col("n_words") >= least_words
    n = scored.where(able).count()
    k = percent * n // 100
    out = ["doc_id", "n_features", "weight", "score"]
    unranked = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*out, unranked)
    last = _fixed(kth_key(scored.where(able).select("key"), n, k))
    drawn = able & (F.col("key") <= last)
    return ranked(scored.where(drawn)).select(*out, "rank").union(scored.where(~drawn).select(*out, unranked))


#: For ``resample`` with its defaults over documents and benchmark. crc32 by its table, a byte at a time.
ORACLE_SQL = r"""
WITH crc_table AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256))::BIGINT AS i)
), doc_words AS (
  SELECT row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents)
), target_words AS (
  SELECT unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), source_words AS (
  SELECT row, unnest(words) AS word FROM doc_words
), vocabulary AS (
  SELECT word, xor(list_reduce(list_prepend(4294967295, list_transform(range(octet_length(encode(word))), lambda i: ('0x' || substr(hex(encode(word)), (2 * i + 1)::INT, 2))::BIGINT)), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
  FROM (SELECT word FROM source_words UNION SELECT word FROM target_words), crc_table
), s AS (SELECT bucket, count(*) AS s FROM source_words JOIN vocabulary USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM target_words JOIN vocabulary USING (word) GROUP BY bucket),
gains AS (
  SELECT b.bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(s), 0) FROM s) + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(t), 0) FROM t) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT unnest(range(10000)) AS bucket) b LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
), weights AS (
  SELECT row, sum(gain)::BIGINT AS weight FROM source_words JOIN vocabulary USING (word) JOIN gains USING (bucket) GROUP BY row
), scored AS (
  SELECT row, doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('2024:' || coalesce(doc_id::VARCHAR, ''))[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM doc_words LEFT JOIN weights USING (row)
), drawn AS (
  SELECT row, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, row) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, rank
FROM scored LEFT JOIN (SELECT row, rank FROM drawn WHERE rank <= 10 * n // 100) USING (row)
"""
