"""Command-line entry points for ``spark-submit`` (one per job of the pipeline).

    spark-submit tallyward/plans/jobs.py land     --lake L --config C --hospital hospital-a --jdbc-url U [--jdbc-option k=v ...]
    spark-submit tallyward/plans/jobs.py bronze   --lake L --claims GLOB --cptcodes PATH
    spark-submit tallyward/plans/jobs.py silver   --lake L [--scope all]
    spark-submit tallyward/plans/jobs.py gold     --lake L
    spark-submit tallyward/plans/jobs.py refresh  --lake L --config C --claims GLOB --cptcodes PATH --jdbc-url-for hospital-a=U ...

``silver`` and ``gold`` rebuild their layer over the current batches, without an extract.
Database options (user, password, driver, fetchsize, ...) come from the caller as
``--jdbc-option key=value``; nothing is stored in code. ``--jdbc-split table=column:n`` reads
a table as n strides of a column, ``--jdbc-ranges table=column+column:n`` as n ranges with
equally many rows. ``--sf-dir`` replaces the databases by the parquet test
tables (tests and local runs). A job whose tables did not all load ends with an error, and so
does one whose claim another run holds.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import os
import sys

if __package__ in (None, ""):  # run as a file by spark-submit
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from tallyward.plans.claims import Claim  # noqa: E402
from tallyward.plans.landing_job import WORKERS, FixtureSource, land_hospital  # noqa: E402
from tallyward.plans.refresh import LoadFailed, as_of_text, build_bronze, build_gold_tables, build_silver_tables, refresh  # noqa: E402
from tallyward.session import apply_pipeline_conf  # noqa: E402
from tallyward.sinks.logs import EventLog, append_event_log, utc, write_event_log_json  # noqa: E402
from tallyward.sources.files import read_load_config  # noqa: E402
from tallyward.sources.jdbc import JdbcConnection, JdbcSource  # noqa: E402
from tallyward.sources.tables import Lake, new_id, utc_now  # noqa: E402
from tallyward.specs import HOSPITALS, MSG_CONFIG_READ  # noqa: E402


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for pair in pairs or []:
        key, _, value = pair.partition("=")
        out[key] = value
    return out


def _run_ts(text: str | None) -> dt.datetime:
    return utc(dt.datetime.fromisoformat(text)) if text else utc_now()


def _splits(pairs: list[str]) -> dict[str, tuple[str, int]]:
    out = {}
    for table, text in _options(pairs).items():
        column, _, n = text.rpartition(":")
        out[table] = (column, int(n))
    return out


def _ranges(pairs: list[str]) -> dict[str, tuple[list[str], int]]:
    return {table: (columns.split("+"), n) for table, (columns, n) in _splits(pairs).items()}


def _hospital(name: str):
    for h in HOSPITALS:
        if h.name == name:
            return h
    raise SystemExit(f"unknown hospital {name!r}; known: {[h.name for h in HOSPITALS]}")


def _source(spark, args, hospital, url: str | None):
    if args.sf_dir:
        return FixtureSource(spark, args.sf_dir, hospital)
    if not url:
        raise SystemExit(f"no JDBC url for {hospital.name}")
    opts = _options(args.jdbc_option)
    conn = JdbcConnection(url=url, driver=opts.pop("driver", None), properties=opts)
    return JdbcSource(spark, conn, _splits(args.jdbc_split), _ranges(args.jdbc_ranges))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tallyward")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("land", "bronze", "silver", "gold", "refresh"):
        s = sub.add_parser(name)
        s.add_argument("--lake", required=True, help="root folder of the lake (shared file system)")
        s.add_argument("--run-ts", help="run clock, ISO format (default: now)")
        if name in ("land", "refresh"):
            s.add_argument("--config", required=True, help="load-control CSV")
            s.add_argument("--workers", type=int, default=WORKERS, help="loads that run at once")
            s.add_argument("--sf-dir", help="use the parquet test tables instead of databases")
            s.add_argument("--jdbc-option", action="append", help="key=value passed to the JDBC reader")
            s.add_argument("--jdbc-split", action="append", help="table=column:n, read as n strides")
            s.add_argument("--jdbc-ranges", action="append", help="table=column[+column...]:n, read as n ranges of equally many rows")
        if name == "land":
            s.add_argument("--hospital", required=True)
            s.add_argument("--jdbc-url")
        if name == "refresh":
            s.add_argument("--jdbc-url-for", action="append", help="hospital=url")
        if name in ("silver", "refresh"):
            s.add_argument("--scope", choices=("latest", "all"), default="latest", help="landing batches silver reads")
        if name in ("bronze", "refresh"):
            s.add_argument("--claims", required=True, help="claims CSV glob")
            s.add_argument("--cptcodes", required=True, help="procedure-code CSV")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = parser().parse_args(argv)
    spark = apply_pipeline_conf(spark or SparkSession.builder.appName(f"tallyward-{args.job}").getOrCreate())
    lake = Lake(args.lake)
    run_ts = _run_ts(args.run_ts)
    as_of = as_of_text(run_ts)
    counts = lambda rows: {"counts": [{"layer": layer, "table": t, "rows": n} for layer, t, n in rows]}

    if args.job in ("bronze", "silver", "gold"):
        with Claim(spark, lake, "refresh") as claim:  # not while a refresh writes the same tables
            if args.job == "bronze":
                return {t: n for _, t, n in build_bronze(spark, lake, args.claims, args.cptcodes, as_of, claim.check)}
            if args.job == "silver":
                return counts(build_silver_tables(spark, lake, as_of, scope=args.scope, check=claim.check))
            return counts(build_gold_tables(spark, lake, as_of, claim.check))

    log = EventLog()
    config = read_load_config(spark, args.config)
    log.log("INFO", MSG_CONFIG_READ)
    if args.job == "land":
        h = _hospital(args.hospital)
        try:
            rows = land_hospital(spark, h, _source(spark, args, h, args.jdbc_url), config, lake, run_ts, log, workers=args.workers)
        finally:
            append_event_log(spark, log, lake.path("control", "pipeline_logs"))
            write_event_log_json(spark, log, f"{lake.root}/logs", new_id())
        if rows.failed:
            raise LoadFailed("; ".join(f"{h.name}/{k}: {v}" for k, v in rows.failed.items()))
        return {"landed": [{"table": r[1], "rows": r[3]} for r in rows]}

    urls = _options(args.jdbc_url_for)
    sources = {h.name: _source(spark, args, h, urls.get(h.name)) for h in HOSPITALS}
    result = refresh(spark, lake, sources, config, args.claims, args.cptcodes, run_ts, log=log, scope=args.scope, workers=args.workers)
    return counts(result.counts)


def cli() -> None:
    print(json.dumps(main()))


if __name__ == "__main__":
    cli()
