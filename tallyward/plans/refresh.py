"""The medallion refresh — landing → bronze → silver → gold, in that order.

Each layer is materialised as parquet before the next reads it (a layer never
overwrites a path it reads), which also cuts the lineage: a lost executor
recomputes from the last written layer, not from the sources.

A refresh is a *cycle*. It is finished when gold is written; until then a new call of
``refresh`` continues it: tables that have landed in the cycle are not extracted again (their
delta would be lost), the others are, and the layers are built from the cycle's batches. If
any load fails the refresh ends with ``LoadFailed`` before bronze, so silver and
gold keep what they had. ``build_bronze``, ``build_silver_tables`` and ``build_gold_tables``
also run on their own, over the current batches.

Of calls that overlap one runs, the others end with ``ClaimHeld``: a refresh holds a claim on the
lake (``claims.py``), which carries the cycle. A dead run's claim ends by its time, and the next call
continues its cycle; should the dead one wake, its next check ends it before it writes.
"""

from __future__ import annotations

import datetime as dt
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tallyward.operators.gold import GOLD_TABLES
from tallyward.operators.layers import SILVER_TABLES, SilverLayer
from tallyward.operators.silver import build_silver
from tallyward.plans.bronze_job import load_claims, load_cptcodes
from tallyward.plans.claims import Claim
from tallyward.plans.landing_job import WORKERS, Source, current_batches, land, name_batch, read_current
from tallyward.sinks.logs import EventLog, append_event_log, utc, write_event_log_json
from tallyward.sources.files import bronze_from_landing
from tallyward.sources.tables import Lake, new_id
from tallyward.specs import ENTITIES, HOSPITALS, Hospital

COUNTS_SCHEMA = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("row_count", T.LongType()),
    ]
)

# Which tables load fully and which by high-water mark (column `modifieddate`).
DEFAULT_LOAD_TYPES = {
    "departments": "full",
    "providers": "full",
    "encounters": "incremental",
    "patients": "incremental",
    "transactions": "incremental",
}


def default_load_config(spark: SparkSession, hospitals: Sequence[Hospital] = HOSPITALS) -> DataFrame:
    """The pipeline's own load-control table: every entity of every hospital."""
    from tallyward.schemas import LOAD_CONFIG

    rows = [
        (
            h.database.removesuffix("_db"),
            h.database,
            entity,
            DEFAULT_LOAD_TYPES[entity],
            "modifieddate",
            "1",
            f"landing/{h.name}/{entity}",
        )
        for h in hospitals
        for entity in ENTITIES
    ]
    return spark.createDataFrame(rows, LOAD_CONFIG)


@dataclass
class RefreshResult:
    counts: list[tuple[str, str, int]] = field(default_factory=list)
    audit_rows: list[tuple] = field(default_factory=list)
    log: EventLog | None = None
    seconds: dict[str, float] = field(default_factory=dict)  # wall time per layer

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.counts, COUNTS_SCHEMA)


class LoadFailed(RuntimeError):
    """Some tables could not be landed; the layers were left as they are."""


def as_of_text(run_ts: dt.datetime) -> str:
    return utc(run_ts).strftime("%Y-%m-%d %H:%M:%S")


def read_silver(spark: SparkSession, lake: Lake) -> SilverLayer:
    return SilverLayer({attr: (lambda t=t: lake.read(spark, "silver", t)) for attr, t in SILVER_TABLES.items()})


# --- the cycle ----------------------------------------------------------------


def open_cycle(claim: Claim) -> tuple[str, bool]:
    """The cycle that was begun and not finished, or a new one; whether it is continued."""
    if claim.facts.get("state") == "begun":
        return claim.facts["cycle"], True
    claim.note(cycle=new_id(), state="begun")
    return claim.facts["cycle"], False


def landed_counts(spark: SparkSession, lake: Lake, cycle: str, hospitals: Sequence[Hospital]) -> list[tuple[str, str, int]]:
    """Rows of the tables that have landed in a cycle, in whichever of its calls."""
    names = {h.database: h.name for h in hospitals}
    found = [(names[db], table, c.rows) for (db, table), c in current_batches(spark, lake).items() if db in names and c.batch.startswith(cycle)]
    return [("landing", f"{name}/{table}", n) for name, table, n in sorted(found)]


def _unchecked() -> None:
    pass


# --- the layers, each on its own ----------------------------------------------


def build_bronze(
    spark: SparkSession, lake: Lake, claims_glob: str, cpt_path: str, as_of: str, check: Callable[[], None] = _unchecked
) -> list[tuple[str, str, int]]:
    """Claims and procedure codes from their files. ``check`` is called before each table, here and below."""
    out = []
    for name, load, path in (("claims", load_claims, claims_glob), ("cptcodes", load_cptcodes, cpt_path)):
        check()
        out.append(("bronze", name, load(spark, path, lake, as_of)))
    return out


def read_bronze(spark: SparkSession, lake: Lake, hospitals: Sequence[Hospital] = HOSPITALS, scope: str = "latest"):
    return bronze_from_landing(
        spark,
        lake.landing,
        {k: [(c.batch, c.kind)] for k, c in current_batches(spark, lake).items()} if scope == "latest" else read_current(spark, lake),
        claims=lambda: lake.read(spark, "bronze", "claims"),
        cptcodes=lambda: lake.read(spark, "bronze", "cptcodes"),
        hospitals=hospitals,
        scope=scope,
    )


def build_silver_tables(
    spark: SparkSession,
    lake: Lake,
    as_of: str,
    hospitals: Sequence[Hospital] = HOSPITALS,
    scope: str = "latest",
    check: Callable[[], None] = _unchecked,
) -> list[tuple[str, str, int]]:
    """Conformed tables over the current landing batches and bronze tables."""
    silver = build_silver(read_bronze(spark, lake, hospitals, scope), as_of)
    out = []
    for name, df in silver.tables().items():
        check()
        out.append(("silver", name, lake.overwrite(df, "silver", name)))
    return out


def build_gold_tables(spark: SparkSession, lake: Lake, as_of: str, check: Callable[[], None] = _unchecked) -> list[tuple[str, str, int]]:
    """KPI tables over the written silver tables."""
    written = read_silver(spark, lake)
    out = []
    for name, fn in GOLD_TABLES.items():
        check()
        out.append(("gold", name, lake.overwrite(fn(written, as_of), "gold", name)))
    return out


def register_tables(spark: SparkSession, lake: Lake, hospitals: Sequence[Hospital] = HOSPITALS) -> None:
    """Name the lake's tables in a session catalog that has not seen their writes (each write
    names its own): ``bronze.<database>_<entity>`` (the current landing batches in place),
    ``bronze.claims`` and ``cptcodes``, silver and gold. Catalog calls only."""
    current = current_batches(spark, lake)
    for h in hospitals:
        for entity in ENTITIES:
            last = current.get((h.database, entity))
            name_batch(spark, lake, h, entity, last.batch if last else None, last.load_date if last else None)
    for layer, names in (("bronze", ("claims", "cptcodes")), ("silver", SILVER_TABLES.values()), ("gold", GOLD_TABLES)):
        for name in names:
            lake.register(spark, layer, name)


def refresh(
    spark: SparkSession,
    lake: Lake,
    sources: Mapping[str, Source],
    config: DataFrame,
    claims_glob: str,
    cpt_path: str,
    run_ts: dt.datetime,
    hospitals: Sequence[Hospital] = HOSPITALS,
    log: EventLog | None = None,
    scope: str = "latest",
    workers: int = WORKERS,
) -> RefreshResult:
    """Run one refresh at ``run_ts`` (naive: UTC), or continue an unfinished one.
    ``scope="latest"`` (the pipeline's semantics) builds silver from the latest landing
    batch of every table; ``scope="all"`` from every batch (``bronze_from_landing``)."""
    run_ts = utc(run_ts)
    as_of = as_of_text(run_ts)
    log = log if log is not None else EventLog()
    result = RefreshResult(log=log)

    try:
        with Claim(spark, lake, "refresh") as claim:
            clock = time.perf_counter()

            def lap(layer: str) -> None:
                nonlocal clock
                now = time.perf_counter()
                result.seconds[layer] = round(now - clock, 3)
                clock = now

            cycle, continued = open_cycle(claim)
            if continued:
                log.log("INFO", f"Continuing the unfinished refresh {cycle}")

            # landing: the loads of all hospitals (extract, write, audit), several at once
            landed = land(spark, hospitals, sources, config, lake, run_ts, log, cycle, workers, claim.check)
            result.audit_rows += landed
            if landed.errors:
                raise LoadFailed("; ".join(f"{hospital}/{table}: {error}" for (hospital, table), error in landed.errors.items()))
            result.counts += landed_counts(spark, lake, cycle, hospitals)
            lap("landing")

            result.counts += build_bronze(spark, lake, claims_glob, cpt_path, as_of, claim.check)
            lap("bronze")
            result.counts += build_silver_tables(spark, lake, as_of, hospitals, scope, claim.check)
            lap("silver")
            result.counts += build_gold_tables(spark, lake, as_of, claim.check)
            lap("gold")
            claim.note(state="finished")
            log.log("SUCCESS", "Medallion refresh finished")
    except Exception as exc:
        log.log("ERROR", f"Medallion refresh failed: {type(exc).__name__}: {exc}")
        raise
    finally:  # the run's events are kept whatever happened
        append_event_log(spark, log, lake.path("control", "pipeline_logs"))
        write_event_log_json(spark, log, f"{lake.root}/logs", new_id())
    return result
