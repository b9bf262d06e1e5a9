import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import types as T

from tallyward.llm import ann, components, simhash
from tallyward.llm.components import connected_components
from tallyward.llm.queries import op9_cross_polytope, op10_simhash

SF = "/root/testdata/sf0.001"
DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("fp", T.StringType()), ("bit", T.StringType()), ("root", T.StringType()))])


def slow_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps, most=4):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= most:
                parent[root(i)] = root(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[root(i)] = min(x, least.get(root(i), x))
    return [least.get(root(i)) for i in range(len(ids))]


def check_simhash(got, rows):
    fps = [slow_fingerprint(t) for _, t in rows]
    expected = sorted(zip([str(i) for i, _ in rows], [f"{f:016x}" for f in fps], map(str, slow_components([i for i, _ in rows], fps))))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == expected


def test_op10_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    check_simhash(op10_simhash(spark, SF).collect(), [(d.doc_id, d.text) for d in docs])


def test_simhash_of_odd_rows(spark):
    rows = [(5, None), (4, ""), (7, " \n"), (3, "One two"), (3, "one  TWO"), (None, "one two"), (None, "ÀB c"), (9, "x" * 50000), (8, "a b c d e " * 9000), (2, "a\x0bb\x85c d"), (1, "É é")]
    df = spark.createDataFrame([(i, t, "clash", "clash", None) for i, t in rows], DOCS)
    check_simhash(simhash.simhash_components(df).collect(), rows)
    assert simhash.simhash_components(spark.createDataFrame([], DOCS)).count() == 0


@pytest.mark.parametrize("bucket,heavy", [(8, 1000), (2048, 1000), (8, 10**9), (0, 10**9)])
def test_links_join_what_all_pairs_join(spark, monkeypatch, bucket, heavy):
    monkeypatch.setattr(simhash, "HEAVY_SHARE", heavy)  # 10**9: every bucket of more than ``bucket`` is split before the shuffle
    rnd = random.Random(3)
    fps = set()
    for _ in range(40):
        center = rnd.getrandbits(64)
        for _ in range(30):
            f = center
            for b in rnd.sample(range(64), rnd.choice([0, 2, 3, 4, 5, 6])):
                f ^= 1 << b
            fps.add(f)
    fps = sorted(fps)
    forest = simhash.Forest()
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    simhash.search(np.array(fps[:0]), (1 << 64) - 1, 4, forest)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    tied = {r.a: r.b for r in connected_components(simhash.links(df, 4)).collect()}
    root = [tied.get(f - (1 << 64) if f >> 63 else f, f - (1 << 64) if f >> 63 else f) for f in fps]
    expected = slow_components(list(range(len(fps))), fps)
    pairs = set(zip(root, expected))
    assert len(pairs) == len(set(root)) == len(set(expected))


def test_big_bucket_search_refines(monkeypatch):
    rnd = random.Random(5)
    base = rnd.getrandbits(64)
    fps = sorted({base ^ sum(1 << b for b in rnd.sample(range(64), 3)) for _ in range(600)})
    roots = []
    for bucket in (10, 10_000):
        monkeypatch.setattr(simhash, "BUCKET", bucket)
        forest = simhash.Forest()
        # pairs within four bits that also share the low 16 bits meet for certain
        simhash.search(np.array(fps, np.uint64), (1 << 64) - 1, 4, forest)
        roots.append([forest.root(f) for f in fps])
    assert roots[0] == roots[1]


def test_one_of_the_blocks_agrees_for_any_differences():
    rnd = random.Random(9)
    for most in (2, 4, 6):
        for segment, own in zip(simhash.segments(most), simhash.blocks(most)):
            assert len(own) == most + 1 and sum(own) == (1 << 64) - 1 - segment
            for _ in range(200):
                change = sum(1 << b for b in rnd.sample(range(64), most))
                assert any(not change & block for block in own)


def test_heavy_buckets_are_dealt_to_several_keys(spark):
    """A third of all fingerprints agree in one segment: their key is split, the others' are not."""
    rnd = random.Random(11)
    low = (1 << 22) - 1
    near = [rnd.getrandbits(64) & ~low | 5 for _ in range(4000)]
    fps = near + [rnd.getrandbits(64) for _ in range(8000)]
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in set(fps)], "fp long").repartition(8)
    before = simhash.variants(df, 4).groupBy("key").count().agg({"count": "max"}).first()[0]
    split = simhash.split_heavy(df, 4)
    after = split.groupBy("key").count().agg({"count": "max"}).first()[0]
    assert before >= 4000 and after < 200
    assert split.select("fp").distinct().count() == len(set(fps))


@pytest.mark.parametrize("share", [1, 1000])
def test_components_do_not_depend_on_which_nodes_are_hubs(spark, monkeypatch, share):
    monkeypatch.setattr(components, "HUB_SHARE", share)
    rnd = random.Random(12)
    edges = [(1, j) for j in range(2, 400)] + [(500 + rnd.randrange(300), 500 + rnd.randrange(300)) for _ in range(250)] + [(900, 390), (900, 901)]
    roots = {}
    find = lambda x: x if roots.setdefault(x, x) == x else find(roots[x])
    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        roots[b] = a
    got = {r.a: r.b for r in connected_components(spark.createDataFrame(edges, "a long, b long").repartition(6)).collect()}
    assert got == {x: find(x) for x in list(roots) if find(x) != x}


def test_components_of_a_long_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(1, j) for j in range(200, 260)] + [(7, 7)]
    got = {r.a: r.b for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(101, 161)}, **{j: 1 for j in range(200, 260)}}


def brute(ids, vectors, every, k):
    out = {}
    for i, q in zip(ids, vectors):
        if i % every == 0:
            scored = sorted((-float(np.dot(q, v)), j) for j, v in zip(ids, vectors) if j != i)
            out[i] = scored[:k]
    return out


def test_op9_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    expected = brute([r.vec_id for r in rows], [np.array(r.embedding, float) for r in rows], 20, 20)
    got = op9_cross_polytope(spark, SF).toPandas()
    hits = 0
    for q, own in got.groupby("query_id"):
        own = own.sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        assert list(zip(-own.score, own.vec_id)) == sorted(zip(-own.score, own.vec_id))
        hits += len(set(own.vec_id) & {j for _, j in expected[q]})
    assert set(got.query_id) == set(expected)
    assert hits / (20 * len(expected)) >= 0.9


VECS = T.StructType([T.StructField(n, t) for n, t in (("vec_id", T.LongType()), ("embedding", T.ArrayType(T.FloatType())), ("vec", T.StringType()), ("norm", T.StringType()), ("score", T.StringType()))])


def test_vectors_that_take_no_part_ties_and_few_candidates(spark):
    nan, inf = math.nan, math.inf
    rows = [(0, [1.0, 0.0]), (40, [2.0, 0.0]), (40, [2.0, 0.0]), (3, [1.0, 1.0]), (2, [1.0, 1.0]), (60, None), (80, [0.0, 0.0]), (100, [nan, 1.0]), (120, [inf, 0.0]), (140, [None, 1.0]), (None, [1.0, 0.0]), (20, []), (160, [1.0, 0.0, 0.0]), (5, [-3.0, 0.0])]
    df = spark.createDataFrame([(i, v, "a", "b", "c") for i, v in rows], VECS)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in ann.nearest(df, 20, 3).collect()}
    assert got == {(0, 1): (40, 2.0), (0, 2): (2, 1.0), (0, 3): (3, 1.0), (40, 1): (0, 2.0), (40, 2): (2, 2.0), (40, 3): (3, 2.0)}
    assert ann.nearest(spark.createDataFrame([], VECS), 20, 3).count() == 0


def test_a_hot_bucket_is_split_and_whole(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 7)
    rng = np.random.default_rng(2)
    hot = rng.normal(size=8)
    vectors = [hot if i % 3 == 0 else rng.normal(size=8) for i in range(150)]
    df = spark.createDataFrame([(i, [float(x) for x in v], None, None, None) for i, v in enumerate(vectors)], VECS)
    vectors = [np.array(v, np.float32).astype(float) for v in vectors]
    got = ann.nearest(df, 30, 5, tables=8, probes=16).collect()
    expected = brute(range(150), vectors, 30, 5)
    for q in (0, 30, 60, 90, 120):  # all hot: ties to the smaller id
        own = [r.vec_id for r in sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])]
        assert own == [j for _, j in expected[q]]


@pytest.mark.parametrize("norms", ["spread", "two", "one long"])
def test_recall_where_norms_differ(spark, monkeypatch, norms):
    monkeypatch.setattr(ann, "HEAD", 100)
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(3000, 64))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    length = {"spread": np.exp(rng.normal(size=3000)), "two": np.where(np.arange(3000) % 2, 1.0, 0.1), "one long": np.where(np.arange(3000) == 7, 10.0, 1.0)}[norms]
    vectors = (vectors * length[:, None]).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist(), None, None, None) for i, v in enumerate(vectors)], VECS)
    expected = brute(range(3000), vectors.astype(float), 50, 20)
    got = ann.nearest(df, 50, 20).toPandas()
    hits = sum(len(set(got[got.query_id == q].vec_id) & {j for _, j in best}) for q, best in expected.items())
    assert len(got) == 20 * len(expected)
    assert hits / (20 * len(expected)) >= 0.9, hits / (20 * len(expected))
