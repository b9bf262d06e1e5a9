"""The landing job: for every load that the control table asks for, extract a batch (full, or
incremental past the high-water mark), write it as landing JSON in a folder of its own and record
an audit row, which makes the batch current and the one before it archive.

Control rows that ask for the same load (table, load type, watermark column) are one load; Spark groups
them. Loads are independent, so up to ``WORKERS`` of them, of all hospitals together, run as
concurrent Spark jobs; audit rows and names are written by one thread, as loads end. The event log's order is that
of the loads, not of their ends. A failing load is logged as an ERROR event and the others
continue; it gets no audit row, so its current batch and its watermark stay and the next
run retries the same delta. A load that can't be read (no such table, no such load type)
never becomes a job.

A hospital's landing is exclusive (``claims.py``): of two runs at once the second ends with ``ClaimHeld``.
"""

from __future__ import annotations

import contextlib
import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators.control import INCREMENTAL, active_load_specs, landed_batches, normalise_load_type, select_batch, specs_with_marks
from tallyward.plans.claims import Claim
from tallyward.schemas import LOAD_DATE, landing_schema
from tallyward.sinks.landing import CODEC, write_landing
from tallyward.sinks.logs import Event, EventLog, append_audit, read_audit, read_marks, utc
from tallyward.sources.files import landing_dir
from tallyward.sources.tables import Lake, new_id
from tallyward.specs import (
    ENTITIES,
    LANDING_DATE_FORMAT,
    MSG_AUDITED,
    MSG_ERROR,
    MSG_EXTRACTED,
    MSG_NO_FILES,
    MSG_WATERMARK,
    Hospital,
)

#: Loads that run at once.
WORKERS = 8


class Source:
    """Anything that can hand over an operational table as a DataFrame."""

    def read(self, table: str) -> DataFrame:  # pragma: no cover - interface
        raise NotImplementedError

    def tables(self) -> Collection[str] | None:
        """The tables that exist, where the source knows them without reading any."""
        return None

    def batch(self, table: str, kind: str, column: str | None, mark: int | None) -> DataFrame:
        """The rows that a load takes (``select_batch``)."""
        return select_batch(self.read(table), kind, column, mark)


@dataclass
class FixtureSource(Source):
    """The driver's parquet tables standing in for a hospital database."""

    spark: SparkSession
    sf_dir: str
    hospital: Hospital

    def tables(self) -> Collection[str]:
        from tallyward import fixtures

        return fixtures.OPERATIONAL

    def read(self, table: str) -> DataFrame:
        from tallyward import fixtures

        if table not in fixtures.OPERATIONAL:
            raise KeyError(f"table {table} does not exist in {self.hospital.database}")
        return fixtures.operational(self.spark, self.sf_dir, self.hospital, table)


class Landed(list):
    """The audit rows of a landing run; ``failed`` has the error of each table without one,
    ``errors`` by (hospital, table)."""

    def __init__(self, rows=(), errors: Mapping[tuple[str, str], str] | None = None):
        super().__init__(rows)
        self.errors = dict(errors or {})

    @property
    def failed(self) -> dict[str, str]:
        return {table: error for (_, table), error in self.errors.items()}


def load_date_of(run_ts: dt.datetime) -> str:
    return utc(run_ts).strftime(LANDING_DATE_FORMAT)


def audit_path(lake: Lake) -> str:
    return lake.path("control", "audit_log")


def read_current(spark: SparkSession, lake: Lake) -> dict[tuple[str, str], list[tuple[str, str]]]:
    """The batches of every table, oldest first (the last is current): the whole log."""
    return landed_batches(read_audit(spark, audit_path(lake)))


@dataclass(frozen=True)
class Current:
    """A table's current batch."""

    batch: str
    kind: str
    rows: int
    load_date: str


def current_batches(spark: SparkSession, lake: Lake) -> dict[tuple[str, str], Current]:
    """(database, table) -> its current batch, from the log's marks."""
    marks = read_marks(spark, audit_path(lake)).where("landed is not null")
    rows = marks.select("data_source", "tablename", "landed.batch", "landed.kind", "landed.record_count", F.unix_micros("landed.load_timestamp").alias("at"))
    at = lambda r: dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=r["at"])
    return {(r["data_source"], r["tablename"]): Current(r["batch"], r["kind"], r["record_count"], load_date_of(at(r))) for r in rows.collect()}  # a row a table


def bronze_name(hospital: Hospital, entity: str) -> str:
    return f"{hospital.database.removesuffix('_db')}_{entity}"


def name_batch(spark: SparkSession, lake: Lake, hospital: Hospital, entity: str, batch: str | None, load_date: str | None) -> None:
    """``bronze.<database>_<entity>`` is this batch."""
    folder = landing_dir(lake.landing, hospital, entity)
    lake.register_batch(spark, bronze_name(hospital, entity), folder, landing_schema(entity, hospital), batch, {LOAD_DATE: load_date} if batch else {LOAD_DATE: ""})


@dataclass
class Load:
    """A distinct load of a run, and what became of it."""

    hospital: Hospital
    table: str
    load_type: str
    column: str | None
    mark: int | None
    mark_text: str | None
    copies: int  # control rows that ask for it
    own: str | None  # the table's current batch
    batch: str
    kind: str | None = None
    error: str | None = None
    done: bool = False  # in this run, before this call
    events: list[Event] = field(default_factory=list)

    def event(self, log: EventLog, kind: str, message: str) -> None:
        self.events.append((kind, message, log.now()))

    def fail(self, log: EventLog, error: str) -> None:
        self.error = error
        self.event(log, "ERROR", MSG_ERROR.format(table=self.table, error=error))


def _text(exc: Exception) -> str:
    return f"{type(exc).__name__}: {exc}"


def _loads(spark: SparkSession, hospital: Hospital, config: DataFrame, lake: Lake, run_id: str) -> list[Load]:
    """The distinct loads of a hospital, in order. A mark leaves Spark as microseconds and text,
    never as a datetime of the driver's zone."""
    specs = specs_with_marks(active_load_specs(config, hospital.database), read_marks(spark, audit_path(lake)))
    rows = specs.select(
        "*", F.unix_micros("last_watermark").alias("mark"), F.date_format("last_watermark", "yyyy-MM-dd HH:mm:ss").alias("mark_text")
    ).drop("last_watermark").orderBy("tablename", "loadtype", "watermark_column").collect()  # a row a distinct load
    return [
        Load(hospital, r["tablename"], r["loadtype"], r["watermark_column"], r["mark"], r["mark_text"], r["copies"], r["batch"], f"{run_id}-{n:04d}")
        for n, r in enumerate(rows)
    ]


def _prepare(load: Load, source: Source, run_id: str, log: EventLog) -> None:
    """Decide what a load does; one that can't be read fails here."""
    if load.own and load.own.startswith(run_id):
        load.done = True
        load.event(log, "INFO", f"{load.hospital.name}/{load.table} has landed in this run already")
        return
    try:
        load.kind = normalise_load_type(load.load_type)
    except ValueError as exc:
        load.fail(log, _text(exc))
        return
    if load.own:
        load.event(log, "INFO", f"Batch {load.own} of {load.hospital.name}/{load.table} stays as archive")
    else:
        load.event(log, "INFO", MSG_NO_FILES.format(table=load.table))
    incremental = load.kind == INCREMENTAL
    load.event(log, "INFO", MSG_WATERMARK.format(table=load.table, watermark=load.mark_text if incremental else None))
    known = source.tables()
    if known is not None and load.table not in known:
        load.fail(log, _text(KeyError(f"table {load.table} does not exist in {load.hospital.database}")))


def _extract(load: Load, source: Source, lake: Lake, run_ts: dt.datetime, log: EventLog) -> int:
    """Extract and write the load's batch; returns its rows."""
    rows = source.batch(load.table, load.kind, load.column, load.mark if load.kind == INCREMENTAL else None)
    load.event(log, "SUCCESS", MSG_EXTRACTED.format(table=load.table))
    count = write_landing(rows, landing_dir(lake.landing, load.hospital, load.table), load.batch, load_date_of(run_ts), CODEC)
    load.event(log, "SUCCESS", f"JSON files written to {load.hospital.name}/{load.table}")
    return count


def land(
    spark: SparkSession,
    hospitals: Sequence[Hospital],
    sources: Mapping[str, Source],
    config: DataFrame,
    lake: Lake,
    run_ts: dt.datetime,
    log: EventLog,
    run_id: str | None = None,
    workers: int = WORKERS,
    check: Callable[[], None] = lambda: None,
) -> Landed:
    """Run the landing jobs of hospitals; returns the audit rows appended, in the loads' order.

    ``run_ts`` is the run's clock (naive: UTC): the landing folder's date and the audit
    ``load_timestamp`` (taken before any extract, so a row changed during the run is
    picked up by the next one). ``run_id`` begins the names of the run's batches; a table
    that already has a batch of this run is left alone, so a run that failed in part is
    continued by calling it again with its id. ``check`` is called before each audit row.
    """
    run_ts, run_id = utc(run_ts), run_id or new_id()
    load_date = load_date_of(run_ts)
    with contextlib.ExitStack() as stack:
        claims = {h.name: stack.enter_context(Claim(spark, lake, f"landing-{h.name}")) for h in hospitals}
        loads = [load for h in hospitals for load in _loads(spark, h, config, lake, run_id)]
        for load in loads:
            _prepare(load, sources[load.hospital.name], run_id, log)
        rows: dict[int, tuple] = {}

        def name(load: Load, batch: str) -> None:
            if lake.names and load.table in ENTITIES:
                name_batch(spark, lake, load.hospital, load.table, batch, load_date)

        with ThreadPoolExecutor(max_workers=max(1, workers)) as pool:
            run = inheritable_thread_target(spark)(_extract)
            waiting = {pool.submit(run, load, sources[load.hospital.name], lake, run_ts, log): n for n, load in enumerate(loads) if not (load.done or load.error)}
            left = set(waiting)
            while left:
                ended, left = wait(left, return_when=FIRST_COMPLETED)
                new: dict[int, tuple] = {}
                for future in ended:
                    load = loads[waiting[future]]
                    try:  # one table's failure must not stop the others
                        count = future.result()
                        claims[load.hospital.name].check()
                        new[waiting[future]] = (load.hospital.database, load.table, load.load_type, count, run_ts, "SUCCESS", load.batch)
                    except Exception as exc:
                        load.fail(log, _text(exc))
                try:  # loads that ended together have one append
                    if new:
                        check()
                        append_audit(spark, [new[n] for n in sorted(new)], audit_path(lake))
                    rows.update(new)
                    for n in new:
                        loads[n].event(log, "SUCCESS", MSG_AUDITED.format(table=loads[n].table))
                except Exception as exc:
                    for n in new:
                        loads[n].fail(log, _text(exc))
        # of several loads of a table the last in order is current, whichever ended first
        current: dict[tuple[str, str], tuple[Load, str]] = {}
        for n, load in enumerate(loads):
            if n in rows or load.done:
                current[(load.hospital.name, load.table)] = (load, load.batch if n in rows else load.own)
        for load, batch in current.values():
            try:
                name(load, batch)
            except Exception as exc:
                load.fail(log, _text(exc))
        log.add_loads((load.table, load.copies, load.events) for load in loads)
        return Landed((rows[n] for n in sorted(rows)), {(load.hospital.name, load.table): load.error for load in loads if load.error})


def land_hospital(
    spark: SparkSession,
    hospital: Hospital,
    source: Source | Callable[[str], DataFrame],
    config: DataFrame,
    lake: Lake,
    run_ts: dt.datetime,
    log: EventLog,
    run_id: str | None = None,
    workers: int = WORKERS,
) -> Landed:
    """``land`` for one hospital; ``source`` may be a function from a table's name to its rows."""
    if not isinstance(source, Source):
        read, source = source, Source()
        source.read = read
    return land(spark, [hospital], {hospital.name: source}, config, lake, run_ts, log, run_id, workers)
