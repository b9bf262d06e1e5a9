"""K4-K6: audit log and pipeline event log.

Both are append-only tables with declared schemas (an event without a table
name would otherwise leave a column Spark cannot infer). An append is a folder of its own, so
jobs that append at the same time do not meet.

The audit log is a chain of manifests over such folders: a *history*, a *tail* of the last
appends, and the *marks* of the history, one row a table. ``read_marks`` reads the marks and the
tail, whose length is bounded by ``TAIL``: a longer one is compacted into a new history with new
marks. The events of landing runs are derived by a plan from the distinct loads
(``EventLog.add_loads``), so the driver holds a load's events once, however many control rows ask
for it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward import schemas
from tallyward.sources.manifest import Chain
from tallyward.sources.tables import MANIFESTS, micros, new_id, utc_now

#: Appends that are read one by one; more are compacted.
TAIL = 32
#: Rows of a file that a compaction writes.
FILE_ROWS = 1_000_000
#: How long the folders of a compacted log stay for readers that have begun.
KEEP_SEGMENTS = dt.timedelta(days=1)

#: Control rows that a task of the events' plan repeats.
COPIES = 10_000


def utc(at: dt.datetime) -> dt.datetime:
    """``at`` as an aware UTC time; a naive one is UTC already."""
    return at.replace(tzinfo=dt.timezone.utc) if at.tzinfo is None else at.astimezone(dt.timezone.utc)


# --- the audit log --------------------------------------------------------------


def audit_frame(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Audit rows (data_source, tablename, load_type, record_count, load_timestamp,
    status, batch); times become aware, so that no driver time zone enters."""
    return spark.createDataFrame([(*r[:4], r[4] and utc(r[4]), *r[5:]) for r in rows], schemas.AUDIT_LOG)


class AuditLog:
    def __init__(self, spark: SparkSession, path: str, tail: int = TAIL):
        self.spark, self.path, self.tail = spark, path.rstrip("/"), tail
        self.chain = Chain(spark, f"{self.path}/{MANIFESTS}")

    def _first(self) -> dict:
        """Before any manifest: what an older log has, files in the folder itself."""
        old = [n for n in self.chain.fs.files(self.path) if n.startswith("part-")]
        return {"history": old, "tail": [], "marks": None, "dropped": []}

    def state(self) -> dict:
        number, state = self.chain.latest()
        return state if number else self._first()

    def _write(self, df: DataFrame, kind: str) -> str:
        name = f"{kind}={new_id()}"
        df.write.parquet(f"{self.path}/{name}")
        return name

    def _rows(self, names: Sequence[str]) -> DataFrame:
        if not names:
            return self.spark.createDataFrame([], schemas.AUDIT_LOG)
        return self.spark.read.schema(schemas.AUDIT_LOG).option("recursiveFileLookup", "true").parquet(*(f"{self.path}/{n}" for n in names))

    def append(self, df: DataFrame) -> None:
        """K4: append rows; they are in the log when the manifest names them."""
        name = self._write(df, "append")
        state = self.chain.update(lambda s: {**s, "tail": [*s["tail"], name]}, self._first)
        if len(state["tail"]) > self.tail:
            self.compact()

    def read(self) -> DataFrame:
        """All rows."""
        state = self.state()
        return self._rows([*state["history"], *state["tail"]])

    def marks(self) -> DataFrame:
        """The schema ``MARKS``: each table's high-water mark, and its last batch."""
        state = self.state()
        if state["marks"] is None:
            return marks_of(self._rows([*state["history"], *state["tail"]]))
        return merged_marks(self._read_marks(state), marks_of(self._rows(state["tail"])))

    def _read_marks(self, state: dict) -> DataFrame:
        return self.spark.read.schema(schemas.MARKS).option("recursiveFileLookup", "true").parquet(f"{self.path}/{state['marks']}")

    def compact(self) -> None:
        """A new history of all rows with its marks. What another writer appends meanwhile stays
        in the tail; if another writer compacts meanwhile, nothing is done."""
        before = self.state()
        rows = self._rows([*before["history"], *before["tail"]])
        history = self._write(rows.repartition(rows.count() // FILE_ROWS + 1), "history")
        marks = self._write(self.marks().repartition(1) if before["marks"] else marks_of(self._rows([history])).repartition(1), "marks")
        now = micros(utc_now())

        def change(state: dict) -> dict:
            if state["history"] != before["history"]:
                return state
            old = [*before["history"], *before["tail"], *([before["marks"]] if before["marks"] else [])]
            dropped = [*state["dropped"], *([n, now] for n in old)]
            return {"history": [history], "tail": [n for n in state["tail"] if n not in before["tail"]], "marks": marks, "dropped": dropped}

        state = self.chain.update(change, self._first)
        if state["history"] != [history]:
            for name in (history, marks):
                self.chain.fs.remove(f"{self.path}/{name}")
            return
        oldest = now - KEEP_SEGMENTS // dt.timedelta(microseconds=1)
        gone = [n for n, at in state["dropped"] if at <= oldest]
        for name in gone:
            self.chain.fs.remove(f"{self.path}/{name}")
        if gone:
            self.chain.update(lambda s: {**s, "dropped": [d for d in s["dropped"] if d[0] not in gone]})


def marks_of(audit: DataFrame) -> DataFrame:
    """The marks of audit rows: the latest load time of each (data_source, tablename), and of
    its successful loads the last batch."""
    landed = F.struct("load_timestamp", "batch", F.lower(F.trim("load_type")).alias("kind"), "record_count")
    done = (F.col("status") == "SUCCESS") & F.col("batch").isNotNull()
    return audit.groupBy("data_source", "tablename").agg(F.max("load_timestamp").alias("latest_timestamp"), F.max(F.when(done, landed)).alias("landed"))


def merged_marks(*marks: DataFrame) -> DataFrame:
    rows = marks[0]
    for more in marks[1:]:
        rows = rows.unionByName(more)
    return rows.groupBy("data_source", "tablename").agg(F.max("latest_timestamp").alias("latest_timestamp"), F.max("landed").alias("landed"))


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The audit log; an empty one (right schema) before the first load."""
    return AuditLog(spark, path).read()


def read_marks(spark: SparkSession, path: str) -> DataFrame:
    """The marks of the audit log, from a bounded number of files."""
    return AuditLog(spark, path).marks()


def append_audit(spark: SparkSession, rows: Iterable[tuple], path: str) -> None:
    """K4: append audit rows. The append makes the batches that they name current."""
    AuditLog(spark, path).append(audit_frame(spark, rows).coalesce(1))  # a file of a few rows


# --- the event log --------------------------------------------------------------

Event = tuple[str, str, str | None]  # type, message, time (ISO text; None: by the tick)


class EventLog:
    """Pipeline events of one run: (timestamp ISO text, event type, message, table).

    With ``tick`` the clock is read once, and each event of the log's order is a tick after the one
    before: the same run gives the same log, in whatever order its loads ended.
    """

    def __init__(self, clock: Callable[[], dt.datetime] = utc_now, tick: dt.timedelta | None = None):
        self.clock, self.tick = clock, tick
        self.start = utc(clock()) if tick else None
        self.count = 0
        self._entries: list[tuple[str, str, str, str | None]] = []
        self._plans: list[list[tuple]] = []

    def now(self) -> str | None:
        """The time of an event that happens now; None where the log's order gives it."""
        return None if self.tick else utc(self.clock()).isoformat()

    def log(self, event_type: str, message: str, table: str | None = None) -> None:
        at = self.now() or (self.start + self.count * self.tick).isoformat()
        self._entries.append((at, event_type, message, table))
        self.count += 1

    def add_loads(self, loads: Iterable[tuple[str, int, Sequence[Event]]]) -> None:
        """The events of loads (table, how many control rows ask for it, its events), in order;
        those of a load once for each of its control rows."""
        rows = []
        for table, copies, events in loads:
            rows.append((table, copies, self.count, [tuple(e) for e in events]))
            self.count += copies * len(events)
        if rows:
            self._plans.append(rows)

    def _plan(self, spark: SparkSession, loads: list[tuple]) -> DataFrame:
        event = "array<struct<event_type:string,message:string,at:string>>"
        rows = spark.createDataFrame(loads, f"table string, copies long, first long, events {event}")
        # a load's control rows in blocks, so that no task repeats them all
        blocks = rows.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(COPIES).cast("long"))))
        if any(copies > COPIES for _, copies, _, _ in loads):
            blocks = blocks.repartition("table", "block")
        last = F.least(F.col("block") + COPIES, F.col("copies")) - 1
        each = blocks.withColumn("copy", F.explode(F.sequence("block", last))).select("*", F.posexplode("events").alias("step", "event"))
        at = F.col("event.at")
        if self.tick:
            place = F.col("first") + F.col("copy") * F.size("events") + F.col("step")
            moment = F.timestamp_micros(place * (self.tick // dt.timedelta(microseconds=1)) + micros(self.start))
            text = F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
            at = F.concat(F.regexp_replace(text, r"\.000000$", ""), F.lit("+00:00"))
        return each.select(at.alias("timestamp"), "event.event_type", "event.message", "table")

    def frame(self, spark: SparkSession) -> DataFrame:
        out = spark.createDataFrame(self._entries, schemas.EVENT_LOG)
        for loads in self._plans:
            out = out.unionByName(self._plan(spark, loads))
        return out

    @property
    def entries(self) -> list[tuple[str, str, str, str | None]]:
        """The events as a list, for logs of few control rows."""
        out = list(self._entries)
        for loads in self._plans:
            for table, copies, _, events in loads:
                out += [(at, kind, message, table) for _ in range(copies) for kind, message, at in events]
        return out


def append_event_log(spark: SparkSession, log: EventLog, path: str) -> int:
    """K5: append the run's events to the event-log table, in a folder of the run."""
    if log.count:
        log.frame(spark).write.parquet(f"{path.rstrip('/')}/run={new_id()}")
    return log.count


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    """The events of all runs."""
    return spark.read.schema(schemas.EVENT_LOG).option("recursiveFileLookup", "true").parquet(path)


def write_event_log_json(spark: SparkSession, log: EventLog, folder: str, stamp: str) -> str:
    """K6: the run's events as one JSON file set ``pipeline_log_<stamp>``."""
    target = f"{folder.rstrip('/')}/pipeline_log_{stamp}"
    frame = log.frame(spark)
    if log.count <= COPIES:  # one file where it is a short one
        frame = frame.coalesce(1)
    frame.write.mode("overwrite").option("ignoreNullFields", "false").json(target)
    return target


def read_event_log_json(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema(schemas.EVENT_LOG).json(target)
