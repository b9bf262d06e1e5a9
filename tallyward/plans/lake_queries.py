"""Registered queries for what several writers and readers of one lake see: names that follow
rewrites, snapshots, landing batches by name, the audit log's marks, exclusive refreshes.

Oracles are SQL over the original tables, as for ``io_queries``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward import fixtures
from tallyward.functions import union_all
from tallyward.plans.claims import ClaimHeld
from tallyward.plans.io_queries import EARLY_RUN_TS, LATE_RUN_TS, RUN_TS, _lake, _refresh_inputs
from tallyward.plans.landing_job import FixtureSource, audit_path, bronze_name, land
from tallyward.plans.refresh import default_load_config, refresh
from tallyward.sinks.logs import AuditLog, EventLog, read_audit
from tallyward.specs import ENTITIES, HOSPITALS, SOURCE_KEYS

#: What a table is rewritten by, in turn.
SPEND_KEYS = ("deptid", "payorid", "procedurecode")


def _spend(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    facts = fixtures.facts(spark, sf_dir, "transactions")
    total = F.expr("CAST(round(sum(CAST(amount AS DECIMAL(18,4))), 2) AS DOUBLE)")
    return facts.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"), total.alias("amount"))


def names_follow_rewrites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3+S7: a table rewritten three times and read by name after each write; what each read
    saw is written down."""
    lake = _lake(spark, "names")
    for i, key in enumerate(SPEND_KEYS):
        lake.overwrite(_spend(spark, sf_dir, key), "gold", "spend")
        lake.overwrite(spark.table("gold.spend").withColumn("rewrite", F.lit(i)), "gold", f"spend_seen_{i}")
    return union_all(spark.table(f"gold.spend_seen_{i}") for i in range(len(SPEND_KEYS)))


def snapshot_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K3: reads by name that were planned before later rewrites; each still has its own version."""
    lake = _lake(spark, "snapshots")
    planned = []
    for i, key in enumerate(SPEND_KEYS):
        lake.overwrite(_spend(spark, sf_dir, key), "gold", "spend")
        planned.append(spark.table("gold.spend").withColumn("rewrite", F.lit(i)))
    return union_all(planned)


def bronze_tables_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ten landing tables by name after two landing runs: the names are at the second
    batches (full tables whole, incremental ones their delta)."""
    lake = _lake(spark, "bronze-names")
    sources = {h.name: FixtureSource(spark, sf_dir, h) for h in HOSPITALS}
    for run_ts in (EARLY_RUN_TS, LATE_RUN_TS):
        land(spark, HOSPITALS, sources, default_load_config(spark), lake, run_ts, EventLog())
    frames = []
    for h in HOSPITALS:
        for entity in ENTITIES:
            back = {conformed: own for own, conformed in h.renames_for(entity).items()}
            key = F.col(back.get(SOURCE_KEYS[entity], SOURCE_KEYS[entity])).alias("source_key")
            name = bronze_name(h, entity)
            frames.append(spark.table(f"bronze.{name}").select(F.lit(name).alias("tablename"), key, "load_date"))
    return union_all(frames)


def audit_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2+K4: the audit history appended in ten parts to a log that compacts after every fourth;
    marks from the compacted marks and the tail, rows and counts from the whole log."""
    lake = _lake(spark, "audit-marks")
    log = AuditLog(spark, audit_path(lake), tail=4)
    history = fixtures.audit_log(spark, sf_dir).withColumn("batch", F.date_format("load_timestamp", "yyyyMMddHHmmssSSSSSS"))
    parts = history.select("data_source", "tablename").distinct().orderBy("data_source", "tablename").collect()  # a row a table
    for part in parts:
        log.append(history.where((F.col("data_source") == part["data_source"]) & (F.col("tablename") == part["tablename"])))
    totals = log.read().groupBy("data_source", "tablename").agg(F.count("*").alias("loads"), F.sum("record_count").alias("record_count"))
    return log.marks().select("data_source", "tablename", "latest_timestamp").join(totals, ["data_source", "tablename"])


class _Meddling(FixtureSource):
    """A source in whose first extract the same refresh is called once more."""

    def meddle(self, call) -> None:
        self.call, self.held = call, 0

    def batch(self, table, kind, column, mark):
        if table == "departments":
            try:
                self.call()
            except ClaimHeld:
                self.held += 1
        return super().batch(table, kind, column, mark)


def refresh_exclusive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A refresh during which two others are called; they end with ``ClaimHeld``, and each
    table has landed once."""
    lake = _lake(spark, "refresh-exclusive")
    sources, *rest = _refresh_inputs(spark, sf_dir, lake)
    call = lambda: refresh(spark, lake, sources, *rest, LATE_RUN_TS)
    meddling = {h.name: _Meddling(spark, sf_dir, h) for h in HOSPITALS}
    for source in meddling.values():
        source.meddle(call)
    refresh(spark, lake, meddling, *rest, RUN_TS)
    if [s.held for s in meddling.values()] != [1] * len(HOSPITALS):
        raise RuntimeError("an overlapping refresh should have been refused")
    landed = read_audit(spark, audit_path(lake)).groupBy("data_source", "tablename")
    return landed.agg(F.count("*").alias("loads"), F.sum("record_count").alias("record_count"), F.max("load_timestamp").alias("load_timestamp"))


LAKE_QUERIES = {f.__name__: f for f in (names_follow_rewrites, snapshot_reads, bronze_tables_by_name, audit_marks, refresh_exclusive)}
