import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from tallyward.llm import substring_dedup as sd
from tallyward.llm.queries import op8_run_length_index
from tallyward.llm.rlbwt import RunIndex

SF = "/root/testdata/sf0.001"


def slow(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept bytes) by a table of all windows."""
    least = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, b in texts:
        for x in range(len(b) - length + 1) if i is not None else ():
            w = b[x : x + length]
            least[w] = min(i, least.get(w, i))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for x in range(len(b) - length + 1) if i is not None else ():
            if least[b[x : x + length]] < i:
                gone[x : x + length] = b"\1" * length
        spans = sum(1 for x in range(len(b)) if gone[x] and (x == 0 or not gone[x - 1]))
        out.append((str(i), len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone) if not g)))
    return sorted(out)


def got(df):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in df.collect())


DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("batch", T.StringType()), ("kept", T.StringType()), ("rows", T.StringType()))])


def frame(spark, rows, parts=3):
    return spark.createDataFrame([(i, t, "b", "k", "r") for i, t in rows], DOCS).repartition(parts)


@pytest.mark.parametrize("depth", [2, 5, 50])
def test_run_index_finds_the_first_owner(depth):
    rnd = random.Random(depth)
    base = [bytes(rnd.choice(b"ab\x00\xff") for _ in range(120)) for _ in range(3)]
    strings = [b[a : a + rnd.randrange(0, 70)] for b, a in ((rnd.choice(base), rnd.randrange(60)) for _ in range(60))]
    owners = np.array([rnd.randrange(30) for _ in strings])
    index = RunIndex(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]), owners, depth)
    assert len(index.run_starts) < len(index.symbols)  # repetition is compressed
    least = {}
    for s, o in zip(strings, owners):
        for x in range(len(s) - depth + 1):
            least[s[x : x + depth]] = min(o, least.get(s[x : x + depth], o))
    assert index.first_owners().tolist() == [least.get(s[x : x + depth], -1) if x + depth <= len(s) else -1 for s in strings for x in range(len(s))]


@pytest.mark.parametrize("bucket", [16 << 20, 2000])
def test_mixed_copies_against_brute_force(spark, monkeypatch, bucket):
    monkeypatch.setattr(sd, "BUCKET_BYTES", bucket)
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choices("abcdeé ", k=rnd.randrange(2, 8)))
    passages = [" ".join(word() for _ in range(rnd.choice([9, 12, 40, 120]))) for _ in range(12)]
    rows = []
    for i in range(150):
        parts = [rnd.choice(passages) if rnd.random() < 0.5 else " ".join(word() for _ in range(20)) for _ in range(rnd.randrange(1, 5))]
        text = " ".join(parts)
        if rnd.random() < 0.4:  # an edit
            at = rnd.randrange(len(text))
            text = text[:at] + "#" + text[at + 1 :]
        rows.append((rnd.randrange(120), text))
    rows += [(500, "a" * 400), (501, "a" * 49), (502, "a" * 50), (503, "ab" * 300), (504, "b" + "ab" * 40), (505, None), (506, ""), (507, "é" * 60), (508, "x" + "é" * 60), (None, passages[4]), (None, None), (3, passages[4]), (2, passages[4]), (-7, passages[5])]
    df = frame(spark, rows)
    assert got(sd.remove_repeats(df)) == slow(rows)
    assert got(sd.remove_repeats(df, hot_bytes=0)) == slow(rows)
    assert {"batch", "rows"} <= set(sd.remove_repeats(df).columns)


def test_window_owners_do_not_depend_on_the_size_of_an_index(monkeypatch):
    rnd = random.Random(3)
    bases = [bytes(rnd.choices(b"abc", k=90)) for _ in range(8)]
    contexts = sorted({(g, bases[g][a : a + 50 + rnd.randrange(30)]) for g in range(8) for a in range(0, 10, 3) for _ in range(3)})
    data = np.frombuffer(b"".join(c for _, c in contexts), np.uint8)
    windows = np.array([len(c) - 49 for _, c in contexts])
    anchor, owner = np.array([g for g, _ in contexts], np.uint32), np.array([rnd.randrange(50) for _ in contexts])
    found = []
    for size in (1, 500, 1 << 20):
        monkeypatch.setattr(sd, "INDEX_BYTES", size)
        found.append(sd._window_owners(data, windows, anchor, owner).tolist())
    least = {}
    for (_, c), o in zip(contexts, owner.tolist()):
        for x in range(len(c) - 49):
            least[c[x : x + 50]] = min(o, least.get(c[x : x + 50], o))
    assert found[0] == found[1] == found[2] == [least[c[x : x + 50]] for _, c in contexts for x in range(len(c) - 49)]


def test_very_long_and_hot_texts(spark):
    rnd = random.Random(2)
    words = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(300)]
    long_text = " ".join(rnd.choices(words, k=20_000))
    line = " ".join(words[:14])
    rows = [(1, long_text), (2, long_text[40_000:] + "tail"), (3, long_text[:100])]
    rows += [(10 + i, f"{i} own words {i * 7} {line} and {i * i} after") for i in range(200)]
    rows += [(300 + i, line * 3) for i in range(100)]
    df = frame(spark, rows, 5)
    assert got(sd.remove_repeats(df)) == slow(rows)
    for hot in (0, 100, 300):  # every anchor, or those with more bytes of contexts, dealt by windows
        assert got(sd.remove_repeats(df, hot_bytes=hot)) == slow(rows)


def test_empty_table(spark):
    assert sd.remove_repeats(frame(spark, [])).count() == 0
    assert sd.remove_repeats(frame(spark, [(1, None), (2, "short")])).count() == 2


def test_op8_against_brute_force(spark):
    docs = [(d.doc_id, d.text) for d in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op8_run_length_index(spark, SF).collect())
    assert rows == [(*x[:4], hashlib.sha256(x[4]).hexdigest()) for x in slow(docs)]


def test_an_anchor_is_hot_by_the_bytes_of_its_contexts():
    """A line that many documents of few batches have, each with an end of its own."""
    import pyarrow as pa

    from tallyward.llm.common import flat_slices

    rnd = random.Random(3)
    line = "".join(rnd.choices("abcdefgh ", k=120))
    tails = ["".join(rnd.choices("abcdefgh ", k=60)) for _ in range(400)]
    dealt = []
    for part in range(2):
        (flat,) = flat_slices(pa.array([line + t for t in tails[200 * part : 200 * part + 200]]), 1 << 30)
        c = sd.Contexts(flat, np.zeros(len(flat), bool))
        anchor, several, contexts = sd._distinct_anchors(c, np.arange(200))
        counts = {}
        for a, h, w in zip(c.anchor.tolist(), c.hash.tolist(), c.windows.tolist()):
            counts.setdefault(a, set()).add((h, w))
        assert [int(2**k) >= len(counts[a]) > 2**k // 2 for a, k in zip(anchor.tolist(), contexts.tolist())] == [True] * len(anchor)
        low = anchor >> np.uint64(64 - 39)
        packed = ((low << np.uint64(1)) | several).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].copy()
        packed[:, 5] = contexts
        dealt.append((part, packed.tobytes(), len(anchor), max(len(x) for x in counts.values())))
    rows = pa.table({"bucket": pa.array([0, 0], pa.int64()), "batch": pa.array([d[0] for d in dealt], pa.int64()), "packed": pa.array([d[1] for d in dealt], pa.binary())})
    most = sum(d[3] for d in dealt)
    for bytes_, some in ((0, True), (most * sd.CONTEXT_BYTES // 2, True), (4 * most * sd.CONTEXT_BYTES, False)):
        answers = sd._shared(bytes_)(rows).column("answer").to_pylist()
        hot = [np.unpackbits(np.split(np.frombuffer(a, np.uint8), 2)[1], count=d[2]) for a, d in zip(answers, dealt)]
        assert any(h.any() for h in hot) == some


@pytest.mark.parametrize("block", [1, 7, 1 << 15])
def test_contexts_are_those_of_every_window_at_any_block(monkeypatch, block):
    monkeypatch.setattr(sd, "_BLOCK", block)
    rng = random.Random(block)
    rows = ["".join(rng.choice("ab") for _ in range(n)).encode() for n in (0, 49, 50, 51, 120, 0, 300, 70)]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    skip = np.array([False] * 7 + [True])
    flat = sd.Flat(np.frombuffer(b"".join(rows), np.uint8), offsets, 0)
    c = sd.Contexts(flat, skip)
    windows = [(r, int(offsets[r]) + i) for r, text in enumerate(rows) if not skip[r] for i in range(len(text) - sd.LENGTH + 1)]
    assert [(int(r), int(f) + i) for r, f, n in zip(c.row, c.first, c.windows) for i in range(n)] == windows
    # equal windows have equal anchors, wherever they stand
    anchors = np.repeat(c.anchor, c.windows)
    for (r, start), anchor in zip(windows, anchors):
        alone = sd.Contexts(sd.Flat(flat.data[start : start + sd.LENGTH], np.array([0, sd.LENGTH]), 0), np.zeros(1, bool))
        assert alone.anchor[0] == anchor, (r, start)
