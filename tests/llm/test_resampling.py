import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oracle_check import check, duck
from tallyward.llm import resampling as R
from tallyward.llm.queries import ORACLE_SQL, op13_importance_resampling

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SCHEMA = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("score", T.StringType()), ("row", T.StringType()), ("key", T.StringType()), ("rank", T.StringType()))])


def slow_features(text, runs):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i : i + n]) for n in range(1, runs + 1) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def slow(docs, target, percent, least, runs):
    """(doc_id, n_features, weight, score) of all rows and, in order, of those drawn."""
    s = Counter(b for _, t in docs for b in slow_features(t, runs)[1])
    t = Counter(b for x in target for b in slow_features(x, runs)[1])
    all_s, all_t = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t)))
    rows, able = [], []
    for doc_id, text in docs:
        words, found = slow_features(text, runs)
        h = int(sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, found))
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
        if words >= least:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    return rows, able[: percent * len(able) // 100]


def random_docs(n):
    rnd = random.Random(3)
    words = ["The", "cat", "é", "中文", "42", "x" * 40, "WORD", "sat", "zażółć"] + [f"w{i}" for i in range(50)]
    docs = [(rnd.randrange(1000), "!? ".join(rnd.choices(words, k=rnd.randrange(60)))) for _ in range(n)]
    same = (77, "one text that repeats " * 10)
    return docs + [(None, None), (5, ""), (6, " \n"), (7, "Long " * 20_000), (8, "y" * 200_000), (None, "some words " * 30)] + [same] * 30


@pytest.mark.parametrize("percent,least,runs", [(10, 20, 1), (50, 0, 3), (100, 20, 2), (0, 20, 1)])
def test_rows_and_draw_are_those_of_a_plain_loop(spark, percent, least, runs):
    docs, target = random_docs(200), ["the cat sat", "the w1 w2 w3", None, ""]
    rnd = random.Random(4)
    rnd.shuffle(docs)
    frame = spark.createDataFrame([(*d, "a", "b", "c", "d") for d in docs], SCHEMA).repartition(7)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = R.resample(frame, bench, percent, least, runs).collect()
    rows, drawn = slow(docs, target, percent, least, runs)
    assert Counter(tuple(r)[:4] for r in got) == Counter(rows)
    winners = sorted((r for r in got if r.rank), key=lambda r: r.rank)
    assert [r.rank for r in winners] == list(range(1, len(drawn) + 1))
    assert [tuple(r)[:4] for r in winners] == drawn


@pytest.mark.parametrize("n,distinct", [(1, 1), (500, 3), (500, 400)])
def test_kth_key_by_few_pivots(spark, n, distinct):
    rnd = random.Random(n + distinct)
    rows = [(rnd.randrange(distinct), rnd.choice([None, *range(5)]), i) for i in range(n)]
    frame = spark.createDataFrame(rows, "score long, doc_id long, row long").select(R._key().alias("key"))
    expected = sorted((-s, d is None, d or 0, i) for s, d, i in rows)
    for k in {1, n // 3 + 1, n}:
        assert R.kth_key(frame, n, k, pivots=2) == expected[k - 1]
    with pytest.raises(ValueError):
        R.kth_key(frame, n, n + 1, pivots=2)


def test_ranks_follow_the_ranges(spark):
    frame = spark.range(2000).select((F.col("id") % 7).alias("score"), F.col("id").alias("doc_id"), F.col("id").alias("row"))
    got = R.ranked(frame.withColumn("key", R._key())).select("rank", "key").collect()
    assert [r.rank for r in sorted(got, key=lambda r: r["key"])] == list(range(1, 2001))


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, text string")
    assert R.resample(none, docs).collect() == []
    assert [r.rank for r in R.resample(docs, none, percent=100, least_words=1).collect()] == [1]


def test_crc_of_words_is_that_of_zlib():
    from tallyward.llm.common import flat_slices
    import pyarrow as pa

    texts = [t for _, t in random_docs(50)]
    for flat in flat_slices(pa.array(texts)):
        rows, found, words = R.features(flat, 2, 1 << 31)
        for i in range(len(flat)):
            n, expected = slow_features(texts[flat.first + i], 2)
            assert n == words[i]
            if len(expected) < 1000:
                text = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), texts[flat.first + i] or ""))
                grams = [*text, *(" ".join(p) for p in zip(text, text[1:]))]
                assert sorted(found[rows == i].tolist()) == sorted(zlib.crc32(g.encode()) % (1 << 31) for g in grams)


def test_query_equals_its_sql(spark):
    ok = check(spark, duck(SF), SF, "op13", op13_importance_resampling, ORACLE_SQL["op13_importance_resampling"])
    assert ok[0], ok
    assert np.isin(op13_importance_resampling(spark, SF).columns, ["doc_id", "n_features", "weight", "score", "rank"]).all()
