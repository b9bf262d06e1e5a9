"""The corpus pipeline: documents in, packed training sequences out.

Each stage calls one operator of ``tallyward.llm`` over all that the stage before
kept, and is written as Parquet and read again as the next one's documents. All but the
last return the columns of ``documents``:

1. quality classifier: documents whose score is under 0.3 go;
2. toxicity: documents whose score is 0.7 or more go;
3. SimHash near-dedup: of each group of rows the one with the smallest doc_id stays (null last; of
   several by a hash of the text, then any); groups are of rows, so unrelated texts under one
   doc_id all stay;
4. suffix-array dedup: bytes of passages that a document with a smaller doc_id has are cut from the
   text; n_chars follows; documents stay, if need be with empty text;
5. best-fit packing: the pieces with their sequence and offset.

Classifiers are fitted on the labelled documents that reach them, outside the folds that
their queries hold out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.llm import packing, quality, simhash, substring_dedup, toxicity
from tallyward.llm.common import read_table, workers_import, written
from tallyward.llm.queries import VOCABULARY

#: Classifiers, shingles and packing have no SQL form; tests compare with brute force.
ORACLE_SQL = None

_SCORE = "_pipeline_score"
_ROW = "_pipeline_row"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model, _SCORE).where(F.col(_SCORE) >= 0.3).drop(_SCORE)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model, _SCORE).where(F.col(_SCORE) < 0.7).drop(_SCORE)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    rows = written(docs.withColumn(_ROW, F.monotonically_increasing_id()), "numbered")
    groups = simhash.simhash_components(rows, shingle=4, max_bits=4, id_column=_ROW).select(F.col("doc_id").alias(_ROW), "component_id")
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.xxhash64("text"), F.col(_ROW))
    ordered = rows.select(_ROW, order.alias("place")).join(groups, _ROW)
    kept = ordered.groupBy("component_id").agg(F.min("place").alias("place")).select(F.col(f"place.{_ROW}").alias(_ROW))
    return rows.join(kept, _ROW, "left_semi").select(docs.columns)


def suffix_array_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    cut = substring_dedup.remove_repeats(docs, cut_text=True)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import(spark)
    return packing.best_fit_packing(docs, VOCABULARY, end_id=2, size=1024)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality_stage),
    ("toxicity", toxicity_stage),
    ("simhash_near_dedup", simhash_stage),
    ("suffix_array_dedup", suffix_array_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage but the last is a written table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
