"""Registered queries for sources, sinks and control operators.

Round trips write with the pipeline's own writers into a fresh folder under the
session's shared folder (``spark.checkpoint.dir``), read back with its readers,
and return the result; the oracle is SQL over the original tables.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward import fixtures
from tallyward.functions import claims_hospital_name, union_all
from tallyward.operators.archive import file_date_parts, read_archive
from tallyward.operators.control import active_load_specs, latest_watermarks, select_batch, watermarks_for
from tallyward.operators.gold import charge_by_provider_department
from tallyward.operators.silver import build_silver, fact_transactions
from tallyward.plans.bronze_job import load_claims
from tallyward.plans.landing_job import FixtureSource, land_hospital, load_date_of, read_current
from tallyward.plans.refresh import default_load_config, read_bronze, refresh, register_tables
from tallyward.schemas import LOAD_DATE, landing_schema
from tallyward.session import apply_pipeline_conf, fresh_dir
from tallyward.sinks.landing import CODEC, landing_form, write_landing
from tallyward.sinks.logs import (
    EventLog,
    append_audit,
    append_event_log,
    read_audit,
    read_event_log,
    read_event_log_json,
    write_event_log_json,
)
from tallyward.sources.files import (
    bronze_from_landing,
    landing_dir,
    read_batches,
    read_claims_csv,
    read_cptcodes_csv,
    read_landing,
    read_load_config,
)
from tallyward.sources.tables import Lake
from tallyward.specs import ENTITIES, HOSPITAL_A, HOSPITAL_B, HOSPITALS, SOURCE_KEYS, Hospital

AS_OF = "2024-06-30 00:00:00"
RUN_TS = dt.datetime(2024, 6, 30, 0, 0, 0, tzinfo=dt.timezone.utc)
#: Two runs between which every incremental table changes.
EARLY_RUN_TS = dt.datetime(1995, 6, 30, 0, 0, 0, tzinfo=dt.timezone.utc)
LATE_RUN_TS = dt.datetime(2024, 9, 30, 6, 0, 0, tzinfo=dt.timezone.utc)
BATCH = "batch-0000"
INCREMENTAL_MARK = "1998-06-30 00:00:00"


def _lake(spark: SparkSession, label: str) -> Lake:
    apply_pipeline_conf(spark)
    return Lake(fresh_dir(spark, label))


def csv_claims_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: claim CSV files by glob, typed by position."""
    lake = _lake(spark, "csv-claims")
    glob = fixtures.stage_claim_files(spark, sf_dir, f"{lake.landing}/claims")
    return read_claims_csv(spark, glob)


def csv_cptcodes_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-line quoted procedure-code CSV; non-integer codes become NULL."""
    lake = _lake(spark, "csv-cpt")
    path = fixtures.stage_cpt_file(spark, sf_dir, f"{lake.landing}/cptcodes/cptcodes.csv")
    return read_cptcodes_csv(spark, path)


def load_config_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The control CSV, untyped."""
    lake = _lake(spark, "config")
    path = fixtures.stage_load_config(spark, sf_dir, f"{lake.root}/configs/load_config.csv")
    return read_load_config(spark, path)


def _landed(spark: SparkSession, sf_dir: str, lake: Lake, h: Hospital, entity: str) -> DataFrame:
    """One table of one hospital written as a landing batch and read back."""
    write_landing(fixtures.operational(spark, sf_dir, h, entity), landing_dir(lake.landing, h, entity), BATCH, load_date_of(RUN_TS), CODEC)
    return read_landing(spark, lake.landing, h, entity, BATCH)


def _landed_everywhere(spark: SparkSession, sf_dir: str, label: str, entity: str) -> DataFrame:
    """A table of both hospitals through landing JSON, in conformed columns with its source."""
    lake = _lake(spark, label)
    return union_all(
        _landed(spark, sf_dir, lake, h, entity).withColumnsRenamed(dict(h.renames_for(entity))).withColumn("datasource", F.lit(h.name))
        for h in HOSPITALS
    )


def bronze_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both hospitals' patients (hospital B's under its own column names on file)."""
    return _landed_everywhere(spark, sf_dir, "bronze-json", "patients")


def _bronze_json(entity: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _landed_everywhere(spark, sf_dir, f"bronze-json-{entity}", entity)

    run.__name__ = f"bronze_json_{entity}"
    run.__doc__ = f"S6: the {entity} of both hospitals through landing JSON."
    return run


def landing_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: both hospitals' transactions written as landing JSON and read back."""
    return _landed_everywhere(spark, sf_dir, "landing-json", "transactions")


def bronze_overwrite_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2: the bronze claims table overwritten twice holds one copy."""
    lake = _lake(spark, "bronze-overwrite")
    for _ in range(2):
        lake.overwrite(fixtures.claims_bronze(spark, sf_dir, AS_OF), "bronze", "claims")
    return lake.read(spark, "bronze", "claims")


def audit_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K4: an audit row for each (source, table, load day) of the audit history, appended
    by the sink in two calls and read back whole."""
    lake = _lake(spark, "audit")
    path = lake.path("control", "audit_log")
    daily = fixtures.audit_log(spark, sf_dir).groupBy("data_source", "tablename", "load_type", "status", F.to_date("load_timestamp"))
    rows = daily.agg(F.sum("record_count").alias("n"), F.unix_micros(F.max("load_timestamp")).alias("at")).collect()
    epoch = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)
    at = lambda micros: None if micros is None else epoch + dt.timedelta(microseconds=micros)
    for source in (HOSPITAL_A.database, HOSPITAL_B.database):
        own = [r for r in rows if r["data_source"] == source]
        append_audit(
            spark,
            [(source, r["tablename"], r["load_type"], r["n"], at(r["at"]), r["status"], None) for r in own],
            path,
        )
    return read_audit(spark, path).drop("batch")


def _logged_run(spark: SparkSession, sf_dir: str, label: str):
    """Landing runs of both hospitals over the load-control table of ``supplier``: its tables
    are unreadable but for ``encounters``. Each event of the log is a second after the one before."""
    lake = _lake(spark, label)
    log = EventLog(clock=lambda: RUN_TS, tick=dt.timedelta(seconds=1))
    config = fixtures.load_config_rows(spark, sf_dir)
    for h in HOSPITALS:
        land_hospital(spark, h, FixtureSource(spark, sf_dir, h), config, lake, RUN_TS, log)
    return lake, log


def event_log_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 + C7: the events of a landing run in which most tables fail, appended to the event table."""
    lake, log = _logged_run(spark, sf_dir, "events-table")
    path = lake.path("control", "pipeline_logs")
    append_event_log(spark, log, path)
    return read_event_log(spark, path)


def event_log_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K6: the same events as a JSON log file."""
    lake, log = _logged_run(spark, sf_dir, "events-json")
    target = write_event_log_json(spark, log, f"{lake.root}/logs", RUN_TS.strftime("%Y%m%d%H%M%S"))
    return read_event_log_json(spark, target).select("timestamp", "event_type", "message", "table")


def active_load_specs_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital A's active load specs."""
    apply_pipeline_conf(spark)
    return active_load_specs(fixtures.load_config_rows(spark, sf_dir), HOSPITAL_A.database)


def latest_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-water mark per (source, table) from the audit log."""
    apply_pipeline_conf(spark)
    return latest_watermarks(fixtures.audit_log(spark, sf_dir))


def latest_watermark_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every active spec's mark, 1900-01-01 where the audit log has none."""
    apply_pipeline_conf(spark)
    specs = active_load_specs(fixtures.load_config_rows(spark, sf_dir))
    return watermarks_for(specs, fixtures.audit_log(spark, sf_dir))


def incremental_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An incremental batch of both hospitals' transactions past a mark."""
    apply_pipeline_conf(spark)
    batches = (select_batch(fixtures.operational(spark, sf_dir, h, "transactions"), "Incremental", "modifieddate", INCREMENTAL_MARK) for h in HOSPITALS)
    return union_all(landing_form(b).withColumn("datasource", F.lit(h.name)) for h, b in zip(HOSPITALS, batches))


def archive_path_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: year / month / day / file name of daily landing file names."""
    apply_pipeline_conf(spark)
    paths = fixtures.landing_paths(spark, sf_dir)
    parts = file_date_parts(F.col("path"))
    return paths.select("path", *(c.alias(n) for n, c in parts.items()))


def archive_partitioned_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encounters of both hospitals landed twice; the first batches are the archive, read
    back typed with year, month and day."""
    lake = _lake(spark, "archive")
    config = default_load_config(spark).where("tablename = 'encounters'")
    for run_ts in (RUN_TS, LATE_RUN_TS):
        for h in HOSPITALS:
            land_hospital(spark, h, FixtureSource(spark, sf_dir, h), config, lake, run_ts, EventLog())
    batches = read_current(spark, lake)
    frames = []
    for h in HOSPITALS:
        older = [b for b, _ in batches[(h.database, "encounters")]][:-1]
        schema = landing_schema("encounters", h, with_load_date=False)
        rows = read_archive(spark, landing_dir(lake.landing, h, "encounters"), older, schema)
        frames.append(rows.drop("batch").withColumn("datasource", F.lit(h.name)))
    return union_all(frames)


def audit_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written per landing table, observed during the write, with the load time."""
    lake = _lake(spark, "audit-count")
    rows = []
    for h in HOSPITALS:
        for entity in fixtures.OPERATIONAL:
            n = write_landing(
                fixtures.operational(spark, sf_dir, h, entity), landing_dir(lake.landing, h, entity), BATCH, load_date_of(RUN_TS), CODEC
            )
            rows.append((h.database, entity, "full", n, RUN_TS, "SUCCESS", BATCH))
    path = lake.path("control", "audit_log")
    append_audit(spark, rows, path)
    return read_audit(spark, path).select("data_source", "tablename", "record_count", "load_timestamp")


def bronze_claims_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze claims carry the file they came from and the load time."""
    lake = _lake(spark, "claims-lineage")
    glob = fixtures.stage_claim_files(spark, sf_dir, f"{lake.landing}/claims")
    load_claims(spark, glob, lake, AS_OF)
    bronze = lake.read(spark, "bronze", "claims")
    return bronze.select(
        "claimid",
        F.regexp_extract("source_file_path", r"(hospital[0-9]+_claim_data\.csv)", 1).alias("claim_file"),
        claims_hospital_name("source_file_path").alias("datasource"),
        "extraction_timestamp",
    )


def incremental_second_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C2+C3+C5+S6: patients, encounters and transactions of both hospitals landed twice; the
    second batch is the delta of rows modified after the first run. All batches, by key."""
    lake = _lake(spark, "two-runs")
    config = default_load_config(spark).where("loadtype = 'incremental'")
    for run_ts in (EARLY_RUN_TS, LATE_RUN_TS):
        for h in HOSPITALS:
            land_hospital(spark, h, FixtureSource(spark, sf_dir, h), config, lake, run_ts, EventLog())
    batches = read_current(spark, lake)
    frames = []
    for h in HOSPITALS:
        for entity in ("patients", "encounters", "transactions"):
            own = [b for b, _ in batches[(h.database, entity)]]
            rows = read_batches(spark, landing_dir(lake.landing, h, entity), own, landing_schema(entity, h))
            rows = rows.withColumnsRenamed(dict(h.renames_for(entity)))
            key = F.col(SOURCE_KEYS[entity]).alias("source_key")
            frames.append(rows.select(F.lit(h.name).alias("datasource"), F.lit(entity).alias("tablename"), key, "modifieddate", LOAD_DATE))
    return union_all(frames)


def silver_from_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 -> V5: ``fact_transactions`` built from both hospitals' landing JSON."""
    lake = _lake(spark, "silver-landing")
    batches = {}
    for h in HOSPITALS:
        _landed(spark, sf_dir, lake, h, "transactions")
        batches[(h.database, "transactions")] = [(BATCH, "full")]
    return fact_transactions(bronze_from_landing(spark, lake.landing, batches), AS_OF)


def refresh_financial_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 end to end: G5 as the refresh writes it (transactions through landing
    JSON, claims through the CSV files), read back from the lake."""
    lake, _ = _run_refresh(spark, sf_dir, "refresh-g5")
    return lake.read(spark, "gold", "financial_metrics")


class _Failing(FixtureSource):
    """A source of which one table can't be read."""

    def read(self, table: str) -> DataFrame:
        if table == "transactions":
            raise ConnectionError(f"{self.hospital.database}.{table} is unreadable")
        return super().read(table)


def _refresh_inputs(spark: SparkSession, sf_dir: str, lake: Lake):
    claims_glob = fixtures.stage_claim_files(spark, sf_dir, f"{lake.root}/drops/claims")
    cpt_path = fixtures.stage_cpt_file(spark, sf_dir, f"{lake.root}/drops/cptcodes/cptcodes.csv")
    config_path = fixtures.stage_load_config(spark, sf_dir, f"{lake.root}/configs/load_config.csv", default_load_config(spark))
    sources = {h.name: FixtureSource(spark, sf_dir, h) for h in HOSPITALS}
    return sources, read_load_config(spark, config_path), claims_glob, cpt_path


def _run_refresh(spark: SparkSession, sf_dir: str, label: str):
    lake = _lake(spark, label)
    result = refresh(spark, lake, *_refresh_inputs(spark, sf_dir, lake), RUN_TS)
    return lake, result


def refresh_retry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7+C9: a refresh that fails in landing (hospital B's transactions) and a second one that
    fails in bronze; the third call continues the cycle, and V5 has every row."""
    lake = _lake(spark, "refresh-retry")
    sources, config, claims_glob, cpt_path = _refresh_inputs(spark, sf_dir, lake)
    broken = {**sources, HOSPITAL_B.name: _Failing(spark, sf_dir, HOSPITAL_B)}
    for given, claims in ((broken, claims_glob), (sources, f"{lake.root}/no-such-file.csv")):
        try:
            refresh(spark, lake, given, config, claims, cpt_path, EARLY_RUN_TS)
        except Exception:
            continue
        raise RuntimeError("the refresh should have failed")
    refresh(spark, lake, sources, config, claims_glob, cpt_path, RUN_TS)
    return lake.read(spark, "silver", "fact_transactions")


def refresh_all_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 with ``scope="all"``: G1 over all batches of two runs (full tables reload, patients
    change, and the test table's transactions, whose keys repeat, do not)."""
    lake = _lake(spark, "refresh-all")
    config = default_load_config(spark)
    for run_ts in (RUN_TS, LATE_RUN_TS):
        for h in HOSPITALS:
            land_hospital(spark, h, FixtureSource(spark, sf_dir, h), config, lake, run_ts, EventLog())
    return charge_by_provider_department(build_silver(read_bronze(spark, lake, scope="all"), AS_OF), AS_OF)


def gold_tables_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K2+K3: the five gold tables of a refresh, read by name from the catalog."""
    lake, _ = _run_refresh(spark, sf_dir, "gold-names")
    register_tables(spark, lake)
    return spark.sql(GOLD_BY_NAME)


GOLD_BY_NAME = """
SELECT 'charge' AS tablename, provider_key AS k1, dept_name AS k2, total_charge_amount AS v1, CAST(total_transactions AS DOUBLE) AS v2
FROM gold.total_charge_amount_per_provider_by_department
UNION ALL SELECT 'history', patient_key, encounter_key, charged_amount, amount_paid FROM gold.patient_history
UNION ALL SELECT 'provider', provider_key, specialization, total_billed_amount, claim_success_rate_percentage FROM gold.provider_performance_summary
UNION ALL SELECT 'department', dept_key, dept_name, total_billed_amount, total_revenue FROM gold.department_performance_analytics
UNION ALL SELECT 'finance', datasource, CAST(reporting_month AS STRING), total_revenue, total_billed_amount FROM gold.financial_metrics
"""


def medallion_refresh_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full refresh (landing, bronze, silver, gold) and its row counts."""
    _, result = _run_refresh(spark, sf_dir, "refresh")
    return result.frame(spark)


IO_QUERIES = {
    "csv_claims_scan": csv_claims_scan,
    "csv_cptcodes_scan": csv_cptcodes_scan,
    "load_config_scan": load_config_scan,
    "bronze_json_roundtrip": bronze_json_roundtrip,
    "landing_json_roundtrip": landing_json_roundtrip,
    "bronze_overwrite_idempotent": bronze_overwrite_idempotent,
    "audit_append": audit_append,
    "event_log_append": event_log_append,
    "event_log_json": event_log_json,
    "active_load_specs": active_load_specs_query,
    "latest_watermark": latest_watermark,
    "latest_watermark_default": latest_watermark_default,
    "incremental_filter": incremental_filter,
    "archive_path_parse": archive_path_parse,
    "archive_partitioned_roundtrip": archive_partitioned_roundtrip,
    "audit_record_count": audit_record_count,
    "bronze_claims_lineage": bronze_claims_lineage,
    "incremental_second_run": incremental_second_run,
    "silver_from_landing": silver_from_landing,
    "refresh_financial_metrics": refresh_financial_metrics,
    "medallion_refresh_counts": medallion_refresh_counts,
    "refresh_retry": refresh_retry,
    "refresh_all_batches": refresh_all_batches,
    "gold_tables_by_name": gold_tables_by_name,
    **{f"bronze_json_{entity}": _bronze_json(entity) for entity in ENTITIES},
}
