"""Extract an operational table over JDBC, full or incremental.

The incremental predicate is a DataFrame ``where``: Catalyst pushes it into the
database query (``PushedFilters`` in the plan), so no SQL text is assembled
from strings. A parallel read runs range queries as separate tasks instead of one task
pulling the whole table, in one of two ways:

* *strides* of a numeric or date column (``ParallelRead``): equal widths between its least and its
  largest value, which cost the database one ``min``/``max`` query;
* *ranges* of any columns (``key_ranges``): the database numbers the batch's rows in the columns' order and
  gives the first of each n-th of them, so ranges have equally many rows however the keys lie. The
  outer ranges are open and one holds the NULL keys, so every row is in exactly one, also rows that
  come between the two queries. A value that many rows share is split by a further column.
"""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyward.operators.control import INCREMENTAL, normalise_load_type, select_batch
from tallyward.plans.landing_job import Source


@dataclass(frozen=True)
class JdbcConnection:
    """Connection options supplied by the caller (never stored in code)."""

    url: str
    driver: str | None = None
    properties: Mapping[str, str] = field(default_factory=dict)  # user, password, fetchsize, ...

    def options(self) -> dict[str, str]:
        out = {"url": self.url, **dict(self.properties)}
        if self.driver:
            out["driver"] = self.driver
        return out


@dataclass(frozen=True)
class ParallelRead:
    """Split the scan into ``num_partitions`` range queries on a numeric/date column."""

    column: str
    lower_bound: str
    upper_bound: str
    num_partitions: int

    def options(self) -> dict[str, str]:
        return {
            "partitionColumn": self.column,
            "lowerBound": self.lower_bound,
            "upperBound": self.upper_bound,
            "numPartitions": str(self.num_partitions),
        }


def jdbc_frame(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def discover_bounds(
    spark: SparkSession,
    conn: JdbcConnection,
    table: str,
    column: str,
    num_partitions: int,
    load_type: str = "full",
    watermark_column: str | None = None,
    watermark: int | str | None = None,
) -> ParallelRead | None:
    """Range bounds for a parallel read of a batch, from one ``min``/``max`` query that
    the JDBC source pushes into the database (``pushDownAggregate``) with the batch's
    predicate; one row comes back. ``None`` for an empty batch."""
    opts = {**reader_options(conn, table), "pushDownAggregate": "true"}
    rows = select_batch(jdbc_frame(spark, opts), load_type, watermark_column, watermark)
    row = rows.agg(F.min(column).alias("lo"), F.max(column).alias("hi")).first()
    if row is None or row["lo"] is None:
        return None
    return ParallelRead(column, str(row["lo"]), str(row["hi"]), num_partitions)


def reader_options(conn: JdbcConnection, table: str, parallel: ParallelRead | None = None) -> dict[str, str]:
    opts = {**conn.options(), "dbtable": table}
    if parallel is not None:
        opts.update(parallel.options())
    return opts


def read_table(spark: SparkSession, conn: JdbcConnection, table: str, parallel: ParallelRead | None = None) -> DataFrame:
    """The whole table (lazy; the schema is fetched, the rows are not)."""
    return jdbc_frame(spark, reader_options(conn, table, parallel))


def extract(
    spark: SparkSession,
    conn: JdbcConnection,
    table: str,
    load_type: str,
    watermark_column: str | None = None,
    watermark: int | str | None = None,
    parallel: ParallelRead | None = None,
) -> DataFrame:
    """A full or incremental batch of ``table`` (see ``select_batch``)."""
    return select_batch(read_table(spark, conn, table, parallel), load_type, watermark_column, watermark)


def sql_literal(value) -> str:
    """A key's value as every SQL dialect reads it."""
    if isinstance(value, bool) or value is None:
        raise TypeError(f"{value!r} is no key")
    if isinstance(value, (int, float, decimal.Decimal)):
        return str(value)
    if isinstance(value, dt.datetime):
        value = value.isoformat(" ")
    return "'" + str(value).replace("'", "''") + "'"


def _before(columns: Sequence[str], key: Sequence) -> str:
    """Rows before a key in the columns' order."""
    terms = []
    for i, (column, value) in enumerate(zip(columns, key)):
        same = [f"{c} = {sql_literal(v)}" for c, v in zip(columns[:i], key)]
        terms.append(" AND ".join([*same, f"{column} < {sql_literal(value)}"]))
    return "(" + " OR ".join(f"({t})" for t in terms) + ")"


def range_predicates(columns: Sequence[str], firsts: Sequence[Sequence]) -> list[str]:
    """WHERE clauses of the ranges that begin at ``firsts`` (in order), and of the rows with a NULL
    key; each row fulfils exactly one."""
    there = " AND ".join(f"{c} IS NOT NULL" for c in columns)
    inner = list(firsts)[1:]  # the first range is open below
    out = []
    for i in range(len(inner) + 1):
        terms = [there]
        if i:
            terms.append(f"NOT {_before(columns, inner[i - 1])}")
        if i < len(inner):
            terms.append(_before(columns, inner[i]))
        out.append(" AND ".join(terms))
    return [*out, " OR ".join(f"{c} IS NULL" for c in columns)]


def quantile_query(table: str, columns: Sequence[str], n: int, where: str | None = None) -> str:
    """SQL for the first key of each n-th of a table's rows, in the order of the key columns."""
    keys = ", ".join(columns)
    terms = [f"{c} IS NOT NULL" for c in columns] + ([where] if where else [])
    parts = f"SELECT {keys}, NTILE({n}) OVER (ORDER BY {keys}) AS part FROM {table} WHERE {' AND '.join(terms)}"
    firsts = f"SELECT {keys}, ROW_NUMBER() OVER (PARTITION BY part ORDER BY {keys}) AS place FROM ({parts}) parts"
    return f"SELECT {keys} FROM ({firsts}) firsts WHERE place = 1"


def key_ranges(
    spark: SparkSession,
    conn: JdbcConnection,
    table: str,
    columns: Sequence[str],
    n: int,
    load_type: str = "full",
    watermark_column: str | None = None,
    watermark: int | None = None,
) -> list[str]:
    """Predicates of n ranges with equally many rows of a batch; the keys come as at most n rows."""
    where = None
    if normalise_load_type(load_type) == INCREMENTAL:
        mark = dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=watermark or 0)
        where = f"{watermark_column} > {sql_literal(mark)}"
    rows = jdbc_frame(spark, reader_options(conn, f"({quantile_query(table, columns, n, where)}) quantiles")).collect()
    return range_predicates(columns, sorted({tuple(r) for r in rows}))


def read_ranges(spark: SparkSession, conn: JdbcConnection, table: str, predicates: Sequence[str]) -> DataFrame:
    """S1 by ranges: a task for each predicate."""
    options = conn.options()
    return spark.read.jdbc(options.pop("url"), table, predicates=list(predicates), properties=options)


class JdbcSource(Source):
    """An operational database as a source of landing batches. ``splits``: table ->
    (numeric or date column, number of strides); ``ranges``: table -> (columns, number of ranges)."""

    def __init__(
        self,
        spark: SparkSession,
        conn: JdbcConnection,
        splits: Mapping[str, tuple[str, int]] | None = None,
        ranges: Mapping[str, tuple[Sequence[str], int]] | None = None,
    ):
        self.spark, self.conn, self.splits, self.ranges = spark, conn, dict(splits or {}), dict(ranges or {})

    def read(self, table: str) -> DataFrame:
        return read_table(self.spark, self.conn, table)

    def batch(self, table: str, kind: str, column: str | None, mark: int | None) -> DataFrame:
        if table in self.ranges:
            predicates = key_ranges(self.spark, self.conn, table, *self.ranges[table], kind, column, mark)
            return select_batch(read_ranges(self.spark, self.conn, table, predicates), kind, column, mark)
        parallel = None
        if table in self.splits:
            parallel = discover_bounds(self.spark, self.conn, table, *self.splits[table], kind, column, mark)
        return extract(self.spark, self.conn, table, kind, column, mark, parallel)
