"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's parquet tables (through ``tallyward.fixtures``)
and runs over whole tables. The run timestamp is a fixed literal so results
can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallyward import fixtures
from tallyward.operators import gold, silver
from tallyward.session import apply_pipeline_conf

AS_OF = "2024-06-30 00:00:00"

Query = Callable[[SparkSession, str], DataFrame]


def _silver(spark: SparkSession, sf_dir: str):
    """The silver layer over one folder of tables, as lazy plans."""
    apply_pipeline_conf(spark)
    return silver.build_silver(fixtures.bronze_layer(spark, sf_dir, AS_OF), AS_OF)


def _silver_table(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _silver(spark, sf_dir).table(name)

    run.__name__ = name
    return run


def _gold(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_silver(spark, sf_dir), AS_OF)

    run.__name__ = fn.__name__
    return run


SILVER_QUERIES: dict[str, Query] = {
    name: _silver_table(name)
    for name in (
        "dim_departments",
        "fact_encounters",
        "dim_patients",
        "dim_providers",
        "fact_transactions",
        "dim_cptcodes",
        "fact_claims",
    )
}

GOLD_QUERIES: dict[str, Query] = {
    "gold_charge_by_provider_dept": _gold(gold.charge_by_provider_department),
    "gold_patient_history": _gold(gold.patient_history),
    "gold_provider_performance": _gold(gold.provider_performance),
    "gold_department_performance": _gold(gold.department_performance),
    "gold_financial_metrics": _gold(gold.financial_metrics_by_month),
}


def all_queries() -> dict[str, Query]:
    from tallyward.plans.io_queries import IO_QUERIES
    from tallyward.plans.lake_queries import LAKE_QUERIES

    return {**SILVER_QUERIES, **GOLD_QUERIES, **IO_QUERIES, **LAKE_QUERIES}
