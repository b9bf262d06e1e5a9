"""Best-fit packing of token sequences (best-two-fit).

``pieces`` tokenises whole texts (a final end id after each) and cuts only
documents longer than a sequence, into pieces of which the first alone may be
shorter. ``pack`` then places the pieces:

* a histogram of piece lengths (as many rows as a sequence has tokens, however
  large the corpus) goes to the driver, where ``best_two_fit`` fills bins
  greedily and swaps a bin's smallest document for two unpacked ones that fill
  its gap more tightly. A bin *pattern* is repeated as often as the counts allow,
  so the work depends on the number of lengths only;
* every piece gets its rank among the pieces of its length from salted counts
  and a running number inside each (length, salt), so no length, however
  frequent, meets in one task;
* a rank falls in one slot of one pattern, which names sequence and offset.

Rows: a null or empty text is the end id alone; repeated rows are packed each; a
null doc_id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.codec import Codec
from tallyward.llm.common import flat_slices, written

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = _PIECES + ", sequence_id long, offset long"


def piece_bounds(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; the first alone may be shorter."""
    first = n % size or min(n, size)
    return [(0, first)] + [(at, size) for at in range(first, n, size)]


def pieces(docs: DataFrame, vocabulary: str, end_id: int, size: int) -> DataFrame:
    """The pieces of every document: doc_id, piece, start, length and the crc32 of its ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(vocabulary)
        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for flat in flat_slices(batch.column(1)):
                ids, at = codec.encode_flat(flat)
                wide = ids.astype("<u4")
                for i in range(len(flat)):
                    own = np.append(wide[at[i] : at[i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, (start, length) in enumerate(piece_bounds(len(own), size)):
                        crc = zlib.crc32(own[start : start + length])
                        rows.append((doc_ids[flat.first + i], k, start, length, crc))
            columns = list(zip(*rows)) if rows else [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return chosen.mapInArrow(cut, _PIECES)


def best_two_fit(counts: np.ndarray, size: int) -> list[tuple[list[int], int]]:
    """Patterns (lengths, how many bins) that hold counts[l] pieces of each length l."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[list[int], int]] = []

    def largest(most: int) -> int:
        found = np.flatnonzero(left[1 : most + 1])
        return int(found[-1]) + 1 if len(found) else 0

    def best_pair(least: int, most: int) -> tuple[int, int] | None:
        """Two left pieces with the largest sum over ``least`` and up to ``most``."""
        lengths = np.flatnonzero(left[:most])
        lengths = lengths[lengths > 0]
        if not len(lengths):
            return None
        at = np.searchsorted(lengths, most - lengths, side="right") - 1
        partner = np.where(at >= 0, lengths[at], 0)
        twin = (partner == lengths) & (left[lengths] < 2)  # one piece can't be both
        partner = np.where(twin, np.where(at >= 1, lengths[np.maximum(at - 1, 0)], 0), partner)
        total = np.where(partner > 0, lengths + partner, 0)
        k = int(np.argmax(total))
        return (int(lengths[k]), int(partner[k])) if total[k] > least else None

    while left.any():
        bin_: list[int] = []
        gap = size
        while gap and (length := largest(gap)):
            bin_.append(length)
            left[length] -= 1
            gap -= length
        if gap and len(bin_) > 1 and (pair := best_pair(bin_[-1], gap + bin_[-1])):
            left[bin_.pop()] += 1
            bin_ += sorted(pair, reverse=True)
            for length in pair:
                left[length] -= 1
        lengths, need = np.unique(bin_, return_counts=True)
        more = int((left[lengths] // need).min())
        left[lengths] -= more * need
        out.append((bin_, 1 + more))
    return out


def slots(patterns: list[tuple[list[int], int]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), by length and rank: the slot
    takes as many ranks as its pattern has bins, one in each sequence."""
    rows, sequence = [], 0
    seen: dict[int, int] = {}
    for lengths, bins in patterns:
        offset = 0
        for length in lengths:
            rows.append((length, seen.get(length, 0), sequence, offset))
            seen[length] = seen.get(length, 0) + bins
            offset += length
        sequence += bins
    return np.array(sorted(rows), np.int64).reshape(-1, 4)


def pack(cut: DataFrame, size: int) -> DataFrame:
    """``cut`` (the columns of ``pieces``, read more than once) with sequence_id and offset."""
    histogram = cut.groupBy("length").count().collect()  # at most ``size`` rows
    counts = np.zeros(size + 1, np.int64)
    for row in histogram:
        counts[row["length"]] = row["count"]
    table = slots(best_two_fit(counts, size))
    # salts grow with the root of the largest count, and so do the rows of each (length, salt)
    n_salts = math.isqrt(int(counts.max(initial=0))) // 8 + 1

    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(n_salts)).cast("int"))
    within = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = salted.groupBy("length", "salt").count().withColumn("before", F.coalesce(F.sum("count").over(within), F.lit(0)))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("row", F.row_number().over(order) - 1).join(before.drop("count"), ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("row") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = np.int64(1) << np.int64(48)
        keys = table[:, 0] * span + table[:, 1]
        for batch in batches:
            length = batch.column(3).to_numpy(zero_copy_only=False)
            rank = batch.column(5).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * span + rank, side="right") - 1
            sequence = table[at, 2] + rank - table[at, 1]
            columns = [batch.column(i) for i in range(5)] + [pa.array(sequence, pa.int64()), pa.array(table[at, 3], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in _PACKED.split(", ")])

    return ranked.mapInArrow(place, _PACKED)


def best_fit_packing(docs: DataFrame, vocabulary: str, end_id: int = 2, size: int = 1024) -> DataFrame:
    """Pieces of all ``docs`` packed into sequences of at most ``size`` tokens."""
    return pack(written(pieces(docs, vocabulary, end_id, size), "pieces"), size)
