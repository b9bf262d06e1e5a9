import hashlib
import random
import re
import struct

import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.llm import fingerprints as fp
from tallyward.llm.queries import op2_closed_syncmers

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("sketch", T.StringType()), ("n_chars", T.LongType()), ("edited", T.StringType()))])
MASK = (1 << 64) - 1


def chained(values):
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode() if isinstance(v, str) else struct.pack("<Q", v & MASK), h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def units_of(text):
    words = [w for w in re.split(r"[ \t\n\x0b\f\r]+", text) if w]
    return [w[i : i + fp.UNIT] for w in words for i in range(0, len(w), fp.UNIT)]


def slow_anchors(text):
    units = [signed(chained([u])) for u in units_of(text)]
    if len(units) < fp.SPAN:
        return [(chained(units) >> 32, 0)] if units else []
    out = []
    for i in range(len(units) - fp.SPAN + 1):
        window = units[i : i + fp.SPAN]
        if min(window) in (window[0], window[-1]):
            out.append((chained(window) >> 32, i))
    return out


def slow_marks(placed):
    return {(h,) for h, _ in placed} | {(x, y, j - i) for (x, i), (y, j) in zip(placed, placed[1:])}


def slow_text(placed):
    return "".join(f"{h:08x}{i - j:x}" for (h, i), (_, j) in zip(placed, [(0, 0), *placed]))


def slow_likeness(a, b):
    a, b = slow_marks(a), slow_marks(b)
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def expected(rows):
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (-(r[0] if r[0] is not None else -(1 << 63)), r[1]))
    out = []
    for k, (i, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        own, changed, nxt = map(slow_anchors, (text, edited, after))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), slow_text(own), slow_text(changed), slow_likeness(own, changed), slow_likeness(own, nxt)))
    return sorted(out, key=str)


def got(df):
    names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=str)


def test_op2_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_BYTES", 20_000)  # many buckets
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = got(op2_closed_syncmers(spark, SF))
    assert rows == expected(docs)
    assert sum(r[5] for r in rows) / len(rows) > 0.4 > 0.1 > sum(r[6] for r in rows) / len(rows)


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(fp, "BUCKET_BYTES", 200)
    rows = [(5, None), (4, ""), (7, " \n\t "), (3, "one two"), (3, "three"), (3, "one two"), (None, "null id " * 30), (None, "abc"), (9, "x" * 3000), (8, "a b c d e " * 900), (2, "中文没有空格" * 200), (1, "🙂 é ß " * 90), (-6, "minus")]
    df = spark.createDataFrame([(i, t, "clash", 0, None) for i, t in rows], DOCS)
    assert got(fp.fingerprint_edits(df)) == expected(rows)
    one = [(1, "the only one")]
    assert got(fp.fingerprint_edits(spark.createDataFrame([(1, "the only one", None, None, None)], DOCS))) == expected(one)
    nulls = [(None, "b"), (None, None)]
    assert got(fp.fingerprint_edits(spark.createDataFrame([(i, t, None, None, None) for i, t in nulls], DOCS))) == expected(nulls)
    assert fp.fingerprint_edits(spark.createDataFrame([], DOCS)).count() == 0


def test_anchors_keep_their_place(spark):
    text = " ".join(f"w{i * i % 97}" for i in range(200))
    df = spark.createDataFrame([(text,)], "text string")
    assert [(a.hash, a.pos) for a in df.select(fp.anchors(F.col("text")).alias("a")).first().a] == slow_anchors(text)


def test_neighbours_are_near_and_a_digit_holds_their_distance(spark):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["a", "bb", "the", "x" * 30, f"w{rnd.randrange(99)}"]) for _ in range(n)) for n in (3, 40, 900)] + ["same " * 200, "\u4e2d\u6587" * 400]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    for r in df.select("i", fp.anchors(F.col("text")).alias("a"), fp.as_text(fp.anchors(F.col("text"))).alias("t"), fp.from_text(fp.as_text(fp.anchors(F.col("text")))).alias("back")).collect():
        steps = [y.pos - x.pos for x, y in zip(r.a, r.a[1:])]
        assert all(0 < x < fp.SPAN for x in steps) and len(r.t) == 9 * len(r.a)
        assert r.back == r.a


def test_likeness_sees_shared_passages_in_texts_of_any_length(spark):
    rnd = random.Random(6)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    text = " ".join(words(60))[:436]
    pairs = [(text, text[:356]), (text, text), ("", ""), ("", "abc"), ("abc", "abc"), ("abc", "abd"), (" \n", ""), (" ".join(words(300)), " ".join(words(300)))]
    for _ in range(20):  # a passage of 60 words in texts of 5,000 and of 20,000
        passage = words(60)
        pairs.append(tuple(" ".join(words(2000) + passage + words(2940)) for _ in range(2)))
    passage = words(60)
    pairs.append(tuple(" ".join(words(9000) + passage + words(10_940)) for _ in range(2)))
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    m = lambda c: fp.marks(fp.anchors(F.col(c)))
    near = [r.near for r in df.select("i", fp.likeness(m("a"), m("b")).alias("near")).orderBy("i").collect()]
    assert near == [slow_likeness(slow_anchors(a), slow_anchors(b)) for a, b in pairs]
    assert near[0] > 0.8 and near[1:5] == [1, 1, 0, 1] and near[7] == 0 and min(near[8:]) > 0


def test_documents_whose_edit_is_much_shorter_stay_near(spark):
    """Texts that end up on another side of any bound of length: 400 code points and their edits."""
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet("/root/testdata/sf0.1/documents.parquet").collect()}
    ids = sorted(docs, reverse=True)
    wanted = (4147, 5637, 5477, 499, 438, 6592)
    rows = [(i, docs[i]) for d in wanted for i in (d, ids[ids.index(d) + 1])]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in sorted(set(rows))], DOCS)
    near = {r.doc_id: r.near_edited for r in fp.fingerprint_edits(df).collect()}
    assert all(near[d] > 0.5 for d in wanted)


def test_plan_has_no_python(spark):
    plan = op2_closed_syncmers(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
