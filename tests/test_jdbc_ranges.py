"""Parallel extracts by ranges of equally many rows. The stand-in database answers the SQL that
the source sends by Spark SQL over temporary views; a range is a partition."""

import datetime as dt
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyward.sources.jdbc import JdbcConnection, JdbcSource, key_ranges, quantile_query, range_predicates, read_ranges, sql_literal
from tallyward.sources.tables import micros

CONN = JdbcConnection(url="jdbc:x", properties={"user": "u"})


class Database:
    """``session.read`` of a JDBC source over one table."""

    def __init__(self, spark, frame):
        self.spark, self.calls = spark, []
        self.table = f"t_{uuid.uuid4().hex[:8]}"
        frame.createOrReplaceTempView(self.table)

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **opts):
        self.opts = opts
        return self

    def load(self):
        self.calls.append(self.opts["dbtable"])
        return self.spark.sql(f"SELECT * FROM {self.opts['dbtable']}")

    def jdbc(self, url, table, predicates, properties):
        assert url == CONN.url and properties == {"user": "u"}
        out = None
        for i, p in enumerate(predicates):
            self.calls.append(p)
            part = self.spark.sql(f"SELECT *, {i} AS task FROM {table} WHERE {p}")
            out = part if out is None else out.union(part)
        return out


def sizes(frame):
    return Counter(r.task for r in frame.select("task").collect())


def even(db, columns, n, rows, **kw):
    """Ranges of ``rows``: each row once, and no range much longer than another."""
    predicates = key_ranges(db, CONN, db.table, columns, n, **kw)
    read = read_ranges(db, CONN, db.table, predicates)
    assert read.count() == rows and read.dropDuplicates(["id"]).count() == rows
    return predicates, read


def test_keys_that_crowd_in_a_corner_give_even_ranges(spark):
    """90 % of the keys in 1 % of their range, some keys NULL."""
    key = F.when(F.col("id") % 100 == 7, None).when(F.col("id") % 10 == 0, F.col("id") * 1000).otherwise(F.col("id"))
    db = Database(spark, spark.range(10_000).select("id", key.alias("k")))
    predicates, read = even(db, ["k"], 8, 10_000)
    nulls = len(predicates) - 1
    got = sizes(read)
    assert got[nulls] == 100 and len(predicates) == 9
    assert max(n for t, n in got.items() if t != nulls) <= 1.05 * 9900 / 8
    # equal strides of the same keys: nearly all rows in one
    strides = read.where("k IS NOT NULL").groupBy(F.floor(F.col("k") / (10_000 * 1000 / 8))).count()
    assert strides.agg(F.max("count")).first()[0] > 8000


def test_a_value_that_most_rows_share_is_split_by_a_further_column(spark):
    db = Database(spark, spark.range(9000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN id ELSE 5 END AS k", "concat('it''s ', id) AS s"))
    alone = sizes(even(db, ["k"], 6, 9000)[1])
    both = sizes(even(db, ["k", "s"], 6, 9000)[1])
    assert max(alone.values()) > 6000 and max(both.values()) <= 1.05 * 9000 / 6


@pytest.mark.parametrize("kind", ["string", "date", "timestamp", "decimal(12,3)", "double"])
def test_keys_of_any_type(spark, kind):
    expr = {
        "string": "concat('a''', id)", "date": "date_add(DATE'2020-01-01', CAST(id AS INT))",
        "timestamp": "timestamp_micros(id * 1000001)", "decimal(12,3)": "CAST(id / 7 AS DECIMAL(12,3))", "double": "CAST(id / 7 AS DOUBLE)",
    }[kind]
    db = Database(spark, spark.range(1000).selectExpr("id", f"{expr} AS k"))
    assert max(sizes(even(db, ["k"], 5, 1000)[1]).values()) <= 210


def test_ranges_of_a_delta_and_of_rows_that_come_later(spark):
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    frame = spark.range(1000).selectExpr("id", "id AS k", "TIMESTAMP'2024-01-01 00:00:00' + make_interval(0,0,0,0,CAST(id AS INT)) AS modifieddate")
    db = Database(spark, frame)
    mark = micros(start + dt.timedelta(hours=599, minutes=30))
    source = JdbcSource(db, CONN, ranges={db.table: (["k"], 4)})
    batch = source.batch(db.table, "incremental", "modifieddate", mark)
    assert sorted(sizes(batch).values()) == [100] * 4
    assert "modifieddate > '2024-01-25 23:30:00'" in db.calls[0]
    # the same predicates over a table that has grown meanwhile, at both ends and in between
    more = spark.createDataFrame([(-5, -5), (601, 601), (5000, 5000), (5001, None)], "id long, k long")
    grown = Database(spark, frame.select("id", "k").where("id <> 601").union(more))
    read = read_ranges(grown, CONN, grown.table, db.calls[1:])
    assert sorted(r.id for r in read.collect()) == sorted([-5, *range(1000), 5000, 5001])


def test_empty_tables_and_few_rows(spark):
    db = Database(spark, spark.range(0).selectExpr("id", "id AS k"))
    assert even(db, ["k"], 4, 0)[0] == ["k IS NOT NULL", "k IS NULL"]
    db = Database(spark, spark.range(2).selectExpr("id", "id AS k"))
    assert len(even(db, ["k"], 4, 2)[0]) == 3


def test_predicates_and_literals():
    assert range_predicates(["a", "b"], [(0, "x"), (1, "y")]) == [
        "a IS NOT NULL AND b IS NOT NULL AND ((a < 1) OR (a = 1 AND b < 'y'))",
        "a IS NOT NULL AND b IS NOT NULL AND NOT ((a < 1) OR (a = 1 AND b < 'y'))",
        "a IS NULL OR b IS NULL",
    ]
    assert "NTILE(7) OVER (ORDER BY a, b)" in quantile_query("t", ["a", "b"], 7)
    with pytest.raises(TypeError):
        sql_literal(None)


def test_the_job_takes_ranges(spark, scratch, monkeypatch):
    from tallyward.plans import jobs

    args = jobs.parser().parse_args(["land", "--lake", scratch, "--config", "c", "--hospital", "hospital-a", "--jdbc-url", "jdbc:x", "--jdbc-ranges", "encounters=a+b:16"])
    source = jobs._source(spark, args, jobs.HOSPITALS[0], "jdbc:x")
    assert source.ranges == {"encounters": (["a", "b"], 16)}
