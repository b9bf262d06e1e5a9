"""S1/S2 wiring without a database: a stand-in session whose JDBC reader
records the options it is given and returns a real DataFrame."""

import datetime as dt

from tallyward.sources.jdbc import JdbcConnection, ParallelRead, discover_bounds, extract


class _Reader:
    def __init__(self, frame, calls):
        self.frame, self.calls, self.opts = frame, calls, {}

    def format(self, name):
        self.opts["format"] = name
        return self

    def options(self, **opts):
        self.opts.update(opts)
        return self

    def load(self):
        self.calls.append(dict(self.opts))
        return self.frame


class _Session:
    """Only ``read`` is used by the JDBC source."""

    def __init__(self, frame):
        self.frame, self.calls = frame, []

    @property
    def read(self):
        return _Reader(self.frame, self.calls)


CONN = JdbcConnection(url="jdbc:postgresql://db/hospital", driver="org.postgresql.Driver", properties={"user": "u"})


def _table(spark):
    return spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1)), (7, dt.datetime(2024, 3, 1)), (9, None)], "id long, modifieddate timestamp"
    )


def test_full_and_incremental_extract(spark):
    fake = _Session(_table(spark))
    full = extract(fake, CONN, "encounters", "Full")
    assert full.count() == 3
    inc = extract(fake, CONN, "encounters", "INCREMENTAL", "modifieddate", "2024-02-01 00:00:00",
                  parallel=ParallelRead("id", "1", "9", 4))
    assert [r.id for r in inc.collect()] == [7]
    opts = fake.calls[-1]
    assert opts["format"] == "jdbc" and opts["dbtable"] == "encounters" and opts["url"] == CONN.url
    assert (opts["partitionColumn"], opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("id", "1", "9", "4")
    assert "WHERE" not in opts["dbtable"].upper()  # the predicate is a DataFrame filter, not SQL text


def test_bounds_come_from_one_aggregate(spark):
    fake = _Session(_table(spark))
    bounds = discover_bounds(fake, CONN, "encounters", "id", 16)
    assert bounds == ParallelRead("id", "1", "9", 16)
    assert fake.calls[-1]["pushDownAggregate"] == "true"
    empty = _Session(spark.createDataFrame([], "id long"))
    assert discover_bounds(empty, CONN, "encounters", "id", 16) is None


def test_jobs_read_a_table_in_ranges_of_its_batch(spark, scratch, monkeypatch):
    from tallyward.plans import jobs
    from tallyward.schemas import LOAD_CONFIG
    from tallyward.sources import jdbc

    calls = []
    frame = spark.createDataFrame(
        [(f"E{i}", i, dt.datetime(2024, 1, 1 + i)) for i in range(9)], "encounterid string, num long, modifieddate timestamp"
    )
    monkeypatch.setattr(jdbc, "jdbc_frame", lambda session, options: calls.append(dict(options)) or frame)
    config = f"{scratch}/config.csv"
    spark.createDataFrame(
        [("h", "hospital_a_db", "encounters", "incremental", "modifieddate", "1", "x"), ("h", "hospital_a_db", "departments", "full", "", "1", "x")],
        LOAD_CONFIG,
    ).write.option("header", True).csv(config)
    args = ["land", "--lake", f"{scratch}/lake", "--config", config, "--hospital", "hospital-a", "--jdbc-url", "jdbc:x", "--jdbc-option",
            "user=u", "--jdbc-split", "encounters=num:4", "--workers", "1"]
    first = jobs.main([*args, "--run-ts", "2024-01-05T00:00:00"], spark=spark)
    assert sorted((t["table"], t["rows"]) for t in first["landed"]) == [("departments", 9), ("encounters", 9)]
    assert [c.get("partitionColumn") for c in calls] == [None, None, "num"]  # departments whole; bounds, then ranges
    ranged = calls[-1]
    assert (ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"], ranged["user"]) == ("0", "8", "4", "u")
    second = jobs.main([*args, "--run-ts", "2024-02-01T00:00:00"], spark=spark)
    assert {t["table"]: t["rows"] for t in second["landed"]}["encounters"] == 4  # modified after January 5
    assert calls[-1]["lowerBound"] == "5"  # the bounds are those of the delta
