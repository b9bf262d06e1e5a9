import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from tallyward.llm import quality, toxicity
from tallyward.llm.common import flat_slices, hash_word, tokens_of
from tallyward.llm.queries import op1_random_indexing, op3_toxicity

SF = "/root/testdata/sf0.01"
DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("score", T.StringType()), ("label", T.StringType()), ("part", T.StringType()))])
LABELS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("quality", T.IntegerType()), ("toxic", T.IntegerType()), ("text", T.StringType()))])


def flat(texts):
    return next(flat_slices(pa.array(texts)))


def held_accuracy(spark, query, column, modulus, held):
    labels = {r.doc_id: r[column] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert 0 <= r.score <= 1
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == held)
    pairs = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    ones, zeros = [s for s, _, y in pairs if y == 1], [s for s, _, y in pairs if y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])
    return auc, np.mean([p == y for _, p, y in pairs])


def test_op1_on_held_out_labels(spark):
    auc, accuracy = held_accuracy(spark, op1_random_indexing, "quality", 5, 0)
    assert auc > 0.95 and accuracy > 0.93


def test_op3_on_held_out_labels(spark):  # one label in twenty is wrong in this table
    auc, accuracy = held_accuracy(spark, op3_toxicity, "toxic", 3, 1)
    assert auc > 0.85 and accuracy > 0.93


ODD = [(1, None), (2, ""), (3, " \n"), (4, "!!!"), (None, "you idiot"), (5, "x" * 100_000), (5, "a b " * 60_000), (6, "é"), (6, "é"), (7, "you"), (8, "i d i o t"), (9, "1d1ot yo4")]


@pytest.mark.parametrize("fit", [quality.classify_quality, toxicity.classify_toxicity])
def test_odd_rows_and_missing_labels(spark, fit):
    rnd = random.Random(0)
    words = ["on", "the", "of", "river"]
    clean = [(100 + i, " ".join(rnd.choices(words, k=30))) for i in range(60)]
    bad = [(200 + i, " ".join(rnd.choices(words, k=15)) + " you IDIOT!!! scum " + "$$$ " * 20) for i in range(60)]
    docs = spark.createDataFrame([(i, t, "c", "c", "c") for i, t in ODD + clean + bad], DOCS)
    known = [(i, 1, 0, "c") for i, _ in clean] + [(i, 0, 1, "c") for i, _ in bad] + [(None, 1, 1, None), (100, None, None, None), (101, 7, 7, None), (5, 1, 0, None), (200, 0, 1, None)]
    rows = fit(docs, spark.createDataFrame(known, LABELS)).collect()
    assert len(rows) == len(ODD) + 120 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 6}) == 1
    good, poor = ([r.score for r in rows if r.doc_id is not None and lo <= r.doc_id < lo + 100] for lo in (100, 200))
    assert (min(good) > max(poor)) if fit is quality.classify_quality else (max(good) < min(poor))
    none = fit(docs, spark.createDataFrame([], LABELS)).collect()
    assert {r.score for r in none} == {0.5}
    assert fit(spark.createDataFrame([], DOCS), spark.createDataFrame(known, LABELS)).count() == 0


def test_context_vectors_add_up_like_brute_force():
    f = flat(["a b c b", "b", "", "c a"])
    words, docs = quality.buckets_of(f)
    places, signs = quality.index_vectors()
    total = np.zeros(quality.WORDS * quality.DIM, np.int64)
    quality.add_contexts(total, words, docs, places, signs)
    expected = np.zeros((quality.WORDS, quality.DIM), np.int64)
    for i in range(len(words)):
        for j in range(len(words)):
            if i != j and docs[i] == docs[j] and abs(i - j) <= quality.REACH:
                for p, s in zip(places[words[j]], signs[words[j]]):
                    expected[words[i], p] += s
    assert (total.reshape(expected.shape) == expected).all()


def test_temperature_lowers_the_loss_of_an_overconfident_network():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 40)).astype(np.float32)  # few rows, many features, noisy labels
    y = (rng.random(500) < 1 / (1 + np.exp(-x[:, 0]))).astype(int)
    net = quality.fit_network(x, y)
    assert net.temperature > 1
    assert np.abs(net.probabilities(x)).max() <= 1


def test_tokens_and_hashes_do_not_cross_rows():
    f = flat(["ab", "cd ef!?", None, "Ab"])
    t = tokens_of(f)
    assert [(f.data[a:b].tobytes(), d) for a, b, d in zip(t.starts, t.ends, t.docs)] == [(b"ab", 0), (b"cd", 1), (b"ef", 1), (b"!?", 1), (b"Ab", 3)]
    h, docs = toxicity.word_hashes(f)
    assert h[0] == h[-1] == hash_word("ab") and len(h) == 4


def test_features_of_known_texts():
    x = toxicity.features(flat(["you are an idiot", "the 1d1ot sat", "i d i o t", "CAPS now", ""]), toxicity.Lexicon())
    assert x[0, 1] == 1 and x[0, 9] == 1 and x[0, 2] == 0.25
    assert x[1, 1] == 0 and x[1, 17] == 1 and x[1, 16] > 0
    assert x[2, 18] > 0 and x[3, 12] == 0.5 and (x[4] == 0).all()


def test_isotonic_is_the_best_rising_fit():
    rng = np.random.default_rng(1)
    p = rng.random(300)
    y = (rng.random(300) < p**2).astype(float)
    fit = toxicity.fit_isotonic(p, y)
    assert (np.diff(fit.value) > 0).all() and (np.diff(fit.at) > 0).all()
    assert abs(fit(p).mean() - y.mean()) < 0.05


def test_trees_learn_an_interaction():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(800, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    margin = toxicity.fit_trees(x, y).margin(x)
    assert np.mean((margin > 0) == (y == 1)) > 0.95


def test_one_labelled_id_with_very_many_rows_is_one_row_of_the_sample(spark):
    from pyspark.sql import functions as F

    from tallyward.llm.labelled import sample

    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 0)], "doc_id long, quality int")
    docs = spark.range(100_000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.unionByName(spark.createDataFrame([(2, "two"), (2, None), (3, "three"), (5, "five"), (None, "six")], "doc_id long, text string"))
    rows = sample(docs, labels, "quality", (1, 9), 10).collect()
    assert sorted((r.doc_id, r.text, r.label) for r in rows) == [(1, "text 0", 1), (2, "two", 0)]
    assert sample(docs, labels, "quality", (1, 9), 1).count() <= 1
