"""Control operators of the landing job: load specs, high-water marks, batch
selection, audit rows.

All of them are DataFrame operations over the control and audit tables, so the
watermarks of every (source, table) come from one aggregation pass over the
audit log instead of one query per table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.schemas import LOAD_CONFIG_COLUMNS
from tallyward.specs import DEFAULT_WATERMARK

FULL, INCREMENTAL = "full", "incremental"


def active_load_specs(config: DataFrame, datasource: str | None = None) -> DataFrame:
    """Active rows of the load-control table (``is_active = '1'``), optionally
    for one datasource; the seven control fields in their order."""
    rows = config.where(F.col("is_active") == F.lit("1"))
    if datasource is not None:
        rows = rows.where(F.col("datasource") == F.lit(datasource))
    return rows.select(*LOAD_CONFIG_COLUMNS)


def latest_watermarks(audit: DataFrame) -> DataFrame:
    """``max(load_timestamp)`` per (data_source, tablename) of the audit log.

    The watermark is the wall clock of the last successful load, as the audit
    log records it — not the maximum of the source's watermark column.
    """
    return audit.groupBy("data_source", "tablename").agg(F.max("load_timestamp").alias("latest_timestamp"))


def landed_batches(audit: DataFrame) -> dict[tuple[str, str], list[tuple[str, str]]]:
    """(data_source, tablename) -> (batch, load type) of its successful loads, oldest
    first; the last one is current. Audit rows are control metadata, one a load."""
    done = audit.where((F.col("status") == "SUCCESS") & F.col("batch").isNotNull())
    rows = done.select("data_source", "tablename", "batch", F.lower(F.trim("load_type")).alias("kind"), F.unix_micros("load_timestamp").alias("at"))
    out: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for r in sorted(rows.collect(), key=lambda r: (r["at"], r["batch"])):
        out.setdefault((r["data_source"], r["tablename"]), []).append((r["batch"], r["kind"]))
    return out


def watermarks_for(specs: DataFrame, audit: DataFrame) -> DataFrame:
    """C2 for a set of load specs: each spec's high-water mark, or the default
    (``1900-01-01 00:00:00``) when the audit log has no row for it."""
    marks = latest_watermarks(audit)
    joined = specs.join(
        marks,
        (specs["datasource"] == marks["data_source"]) & (specs["tablename"] == marks["tablename"]),
        "left",
    )
    return joined.select(
        specs["datasource"],
        specs["tablename"],
        specs["loadtype"],
        specs["watermark"].alias("watermark_column"),
        F.coalesce(marks["latest_timestamp"], F.lit(DEFAULT_WATERMARK).cast("timestamp")).alias("last_watermark"),
    )


def specs_with_marks(specs: DataFrame, marks: DataFrame) -> DataFrame:
    """C2 over the audit log's marks: the distinct loads of load specs, each with its high-water
    mark, the table's last batch, and how many specs ask for it (``copies``)."""
    loads = specs.groupBy("datasource", "tablename", "loadtype", "watermark").agg(F.count("*").alias("copies"))
    joined = loads.join(marks, (loads["datasource"] == marks["data_source"]) & (loads["tablename"] == marks["tablename"]), "left")
    return joined.select(
        loads["datasource"],
        loads["tablename"],
        loads["loadtype"],
        loads["watermark"].alias("watermark_column"),
        F.coalesce(marks["latest_timestamp"], F.lit(DEFAULT_WATERMARK).cast("timestamp")).alias("last_watermark"),
        marks["landed"]["batch"].alias("batch"),
        "copies",
    )


def normalise_load_type(load_type: str) -> str:
    kind = (load_type or "").strip().lower()
    if kind not in (FULL, INCREMENTAL):
        raise ValueError(f"unknown load type {load_type!r}: expected 'full' or 'incremental'")
    return kind


def select_batch(df: DataFrame, load_type: str, watermark_column: str | None = None, watermark=None) -> DataFrame:
    """The rows a load takes — all of them (full), or those whose watermark
    column is strictly after the last watermark (incremental). Rows with a NULL
    watermark value never load incrementally. The predicate is a plain ``where``,
    so a JDBC or parquet source receives it as a pushed filter.

    ``watermark``: microseconds since the epoch (what the landing job carries, free of any
    time zone), or text in the session's time zone.
    """
    kind = normalise_load_type(load_type)
    if kind == FULL:
        return df
    if not watermark_column:
        raise ValueError("an incremental load needs a watermark column")
    if isinstance(watermark, int):
        mark = F.timestamp_micros(F.lit(watermark))
    elif watermark is None or isinstance(watermark, str):
        mark = F.lit(watermark or DEFAULT_WATERMARK).cast("timestamp")
    else:  # a datetime would carry the driver's time zone
        raise TypeError("a watermark is microseconds or text")
    return df.where(F.col(watermark_column) > mark)

