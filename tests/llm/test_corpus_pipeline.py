import pytest
from pyspark.sql import types as T

import corpus_pipeline as cp
from tallyward.llm.queries import VOCABULARY
from tests_llm_helpers import check_packing, slow_components, slow_fingerprint, slow_repeats

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows that each stage returned over documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in cp.STAGES:
        docs = cp.written(stage(spark, docs, SF), name)
        out.append(docs.collect())
    return out


def test_stage_names_and_columns(stages):
    assert [n for n, _ in cp.STAGES] == ["quality_classifier", "toxicity", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]
    for rows in stages[1:-1]:
        assert rows[0].__fields__ == stages[0][0].__fields__


def test_classifiers_drop_rows_and_change_none(stages):
    for before, after in zip(stages[:2], stages[1:3]):
        known = {r.doc_id: r for r in before}
        assert 0 < len(after) < len(before)
        assert all(known[r.doc_id] == r for r in after)


def test_near_dedup_keeps_the_first_of_each_group(stages):
    before, after = stages[2], stages[3]
    ids = [r.doc_id for r in before]
    groups = slow_components(ids, [slow_fingerprint(r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(set(groups))


def test_repeats_are_cut_from_texts(stages):
    before, after = stages[3], {r.doc_id: r for r in stages[4]}
    assert len(after) == len(before)
    for doc_id, _, _, _, kept in slow_repeats([(r.doc_id, r.text) for r in before]):
        row = after[int(doc_id)]
        assert row.text == kept.decode("utf-8", "ignore") and row.n_chars == len(row.text)


def test_last_stage_packs_all_kept_documents(spark, stages):
    import pandas as pd
    from tokenizers import Tokenizer

    rows = pd.DataFrame([r.asDict() for r in stages[-1]])
    texts = {r.doc_id: r.text for r in stages[4]}
    assert set(rows.doc_id) == set(texts)
    check_packing(rows, texts, Tokenizer.from_file(VOCABULARY), 1024)


DOCS = T.StructType([T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()), ("score", T.StringType()), ("rows", T.StringType()), ("label", T.StringType()), ("fp", T.StringType()))])
ODD = [(1, None), (2, ""), (2, ""), (None, "a text without id"), (None, None), (3, "w " * 30_000), (4, "some words of a text"), (4, "some words of a text"), (5, "Some words of a text")]


@pytest.mark.parametrize("name,stage", cp.STAGES)
def test_each_stage_over_odd_rows_and_an_empty_table(spark, name, stage):
    rows = [(i, t, None, "s", None, "clash", "clash", None, "clash") for i, t in ODD]
    docs = spark.createDataFrame(rows, DOCS)
    got = stage(spark, docs, SF)
    if name != "best_fit_packing":
        assert got.columns == docs.columns
    assert got.count() <= len(rows) or name == "best_fit_packing"
    if name == "simhash_near_dedup":
        assert sorted(map(str, (r.doc_id for r in got.collect()))) == ["1", "3", "4", "None"]  # the null text is a copy of 1's
    empty = stage(spark, spark.createDataFrame([], DOCS), SF)
    assert empty.count() == 0


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    got = cp.run(spark, SF)
    key = lambda r: (r.doc_id, r.piece, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, got.collect())) == sorted(map(key, stages[-1]))


def test_unrelated_texts_of_one_id_and_copies_without_id(spark):
    """Groups are of rows: (7, a) and (7, b) both stay, a copy of 7's second text goes whatever its id."""
    a, b, c = "alpha beta gamma delta epsilon zeta eta theta", "one two three four five six seven eight", "words that no other row of this table has at all"
    rows = [(7, a), (7, b), (9, b), (None, b), (None, c), (None, c), (7, a), (8, c + " but for these")]
    docs = spark.createDataFrame([(i, t, None, "s", None, None, None, None, None) for i, t in rows], DOCS).repartition(4)
    got = sorted((str(r.doc_id), r.text) for r in cp.simhash_stage(spark, docs, SF).collect())
    groups = slow_components(list(range(len(rows))), [slow_fingerprint(t) for _, t in rows])
    assert len(got) == len(set(groups)) == 4
    assert got == sorted([("7", a), ("7", b), ("None", c), ("8", c + " but for these")])
