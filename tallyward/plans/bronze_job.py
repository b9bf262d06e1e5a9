"""Claims and procedure-code files to bronze tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tallyward.functions.dates import run_timestamp
from tallyward.sources.files import read_claims_csv, read_cptcodes_csv, with_lineage
from tallyward.sources.tables import Lake


def load_claims(spark: SparkSession, claims_glob: str, lake: Lake, as_of: str) -> int:
    """Typed claim files → bronze ``claims`` with source file and load time."""
    return lake.overwrite(with_lineage(read_claims_csv(spark, claims_glob), as_of), "bronze", "claims")


def load_cptcodes(spark: SparkSession, cpt_path: str, lake: Lake, as_of: str) -> int:
    """Procedure-code file → bronze ``cptcodes`` with load time."""
    df = read_cptcodes_csv(spark, cpt_path).withColumn("extraction_timestamp", run_timestamp(as_of))
    return lake.overwrite(df, "bronze", "cptcodes")
