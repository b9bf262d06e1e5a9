"""Tables of the lake under several writers and readers: manifests, names, versions and pins."""

import datetime as dt
import json
import threading

import pytest

from tallyward.schemas import landing_schema
from tallyward.sources import manifest
from tallyward.sources.manifest import Chain, FileSystem
from tallyward.sources.tables import VERSION, Lake, new_id, write_counted
from tallyward.specs import HOSPITAL_A

NOW = dt.datetime.now(dt.timezone.utc)
LATER = NOW + dt.timedelta(days=30)


def frame(spark, n):
    return spark.range(n).toDF("x")


# --- manifests ---


def test_a_manifest_is_created_once(spark, scratch):
    fs = FileSystem(spark, scratch)
    assert fs.create(f"{scratch}/m/1.json", "one") and not fs.create(f"{scratch}/m/1.json", "two")
    assert fs.read_text(f"{scratch}/m/1.json") == "one"
    assert fs.files(f"{scratch}/m") == ["1.json"]  # nothing is left beside it


def test_the_rename_way_of_other_file_systems_does_not_replace(spark, scratch):
    fs = FileSystem(spark, scratch)

    class Other:
        """The same folder under a scheme of its own."""

        def __init__(self, inner):
            self.inner = inner

        def getScheme(self):
            return "other"

        def __getattr__(self, name):
            return getattr(self.inner, name)

    fs._fs = Other(fs._fs)
    assert fs.create(f"{scratch}/m/1.json", "one") and not fs.create(f"{scratch}/m/1.json", "two")
    assert fs.read_text(f"{scratch}/m/1.json") == "one"


def test_updates_of_many_threads_are_all_in_the_state(spark, scratch):
    def add(i):
        Chain(spark, f"{scratch}/chain").update(lambda s: {"seen": [*s.get("seen", []), i]})

    threads = [threading.Thread(target=add, args=(i,)) for i in range(12)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    number, state = Chain(spark, f"{scratch}/chain").latest()
    assert number == 12 and sorted(state["seen"]) == list(range(12))


def test_old_manifests_go(spark, scratch):
    chain = Chain(spark, f"{scratch}/chain")
    for i in range(manifest.KEPT + 15):
        chain.update(lambda s: {"n": s.get("n", 0) + 1})
    assert len(chain.fs.files(chain.folder)) == manifest.KEPT and chain.latest()[1] == {"n": manifest.KEPT + 15}


# --- names ---


def test_a_name_follows_every_write(spark, scratch):
    lake = Lake(scratch)
    for n in (1, 2, 3, 4, 5):
        lake.overwrite(frame(spark, n), "gold", "followed")
        assert spark.table("gold.followed").count() == n == lake.read(spark, "gold", "followed").count()


def test_a_name_takes_a_new_schema_and_replaces_a_table(spark, scratch):
    lake = Lake(scratch)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS gold LOCATION '{scratch}/catalog/gold'")
    spark.sql(f"CREATE TABLE gold.older (y INT) USING parquet LOCATION '{scratch}/older'")
    lake.overwrite(frame(spark, 2), "gold", "older")
    assert spark.table("gold.older").columns == ["x"]
    lake.overwrite(frame(spark, 2).selectExpr("x", "x + 1 AS z"), "gold", "older")
    assert spark.table("gold.older").columns == ["x", "z"]


def test_a_failed_name_is_the_current_version_after_the_next_register(spark, scratch):
    """A write of another session, whose catalog this one does not see."""
    lake, other = Lake(scratch), Lake(scratch, names=False)
    lake.overwrite(frame(spark, 1), "gold", "apart")
    other.overwrite(frame(spark, 7), "gold", "apart")
    assert spark.table("gold.apart").count() == 1 and lake.read(spark, "gold", "apart").count() == 7
    lake.register(spark, "gold", "apart")
    assert spark.table("gold.apart").count() == 7


def test_two_writers_commit_both_and_the_name_is_the_last(spark, scratch):
    lake = Lake(scratch)
    errors = []

    def write(n):
        try:
            lake.overwrite(frame(spark, n), "gold", "raced")
        except Exception as exc:
            errors.append(exc)

    threads = [threading.Thread(target=write, args=(n,)) for n in (10, 20, 30, 40)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and len(lake.versions(spark, "gold", "raced")) == 4
    assert spark.table("gold.raced").count() == lake.read(spark, "gold", "raced").count()


def test_a_batch_is_named_without_a_look_at_its_files(spark, scratch):
    """There is no file yet, and none is discovered."""
    lake = Lake(scratch)
    metric = spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    before = metric.getCount()
    folder = f"{scratch}/landing/hospital-a/departments"
    for batch, day in (("b1", "30062024"), ("b2", "01072024")):
        lake.register_batch(spark, "plan_only", folder, landing_schema("departments", HOSPITAL_A), batch, {"load_date": day})
    assert metric.getCount() == before
    for batch, day, rows in (("b1", "30062024", 2), ("b2", "01072024", 3)):
        place = f"{folder}/batch={batch}/load_date={day}"
        spark.range(rows).selectExpr("concat('D', id) AS deptid", "'n' AS name").write.mode("append").json(place)
    spark.catalog.refreshTable("landing.plan_only")
    assert {tuple(r) for r in spark.table("bronze.plan_only").select("deptid", "load_date").collect()} == {(f"D{i}", "01072024") for i in range(3)}
    plan = spark.table("bronze.plan_only")._jdf.queryExecution().toString()
    assert "batch=b1" not in plan.split("== Physical Plan ==")[1]


# --- versions and pins ---


def test_a_planned_read_survives_rewrites(spark, scratch):
    lake = Lake(scratch)
    lake.overwrite(frame(spark, 5), "gold", "kept")
    by_path, by_name = lake.read(spark, "gold", "kept"), spark.table("gold.kept")
    for n in (6, 7, 8):
        lake.overwrite(frame(spark, n), "gold", "kept")
    assert by_path.count() == by_name.count() == 5


def test_versions_go_by_the_time_they_were_replaced(spark, scratch):
    lake = Lake(scratch, keep=dt.timedelta(hours=2))
    for n in (1, 2, 3):
        lake.overwrite(frame(spark, n), "gold", "aged")
    chain = lake._chain(spark, "gold", "aged")
    hours = [5, 3, 1]  # the first was written 5 hours ago and replaced 3 hours ago

    def age(state):
        at = lambda h: (NOW - dt.timedelta(hours=h) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
        return {**state, "versions": [[v, at(h)] for (v, _), h in zip(state["versions"], hours)]}

    chain.update(age)
    first = lake.versions(spark, "gold", "aged")[0]
    assert lake.expire(spark, "gold", "aged") == [first.rpartition("/")[2]]
    assert [spark.read.parquet(v).count() for v in lake.versions(spark, "gold", "aged")] == [2, 3]
    assert not FileSystem(spark, first).exists(first)


def test_a_pinned_version_stays(spark, scratch):
    lake = Lake(scratch, keep=dt.timedelta(0))
    lake.overwrite(frame(spark, 5), "gold", "pinned")
    with lake.pinned(spark, "gold", "pinned", hours=24 * 60) as df:
        for n in (6, 7):
            lake.overwrite(frame(spark, n), "gold", "pinned")
        assert lake.expire(spark, "gold", "pinned", now=LATER) == []
        assert df.count() == 5
        assert len(lake.versions(spark, "gold", "pinned")) == 2  # 6 was neither pinned nor young
    lake.expire(spark, "gold", "pinned", now=LATER)
    assert [spark.read.parquet(v).count() for v in lake.versions(spark, "gold", "pinned")] == [7]


def test_a_dead_readers_pin_ends(spark, scratch):
    lake = Lake(scratch)
    lake.overwrite(frame(spark, 1), "gold", "left")
    reader = lake.pinned(spark, "gold", "left", hours=1)
    reader.__enter__()  # and never left
    lake.overwrite(frame(spark, 2), "gold", "left")
    assert len(lake.expire(spark, "gold", "left", now=LATER)) == 1
    assert FileSystem(spark, scratch).files(f"{scratch}/gold/left/_pins") == []


def test_a_version_pinned_after_it_left_the_manifest_keeps_its_folder(spark, scratch, monkeypatch):
    """A reader that chose its version before ``expire`` and pins it just after the manifest's commit."""
    lake = Lake(scratch, keep=dt.timedelta(0))
    lake.overwrite(frame(spark, 1), "gold", "late")
    first = lake.current(spark, "gold", "late")
    lake.keep = dt.timedelta(days=7)
    lake.overwrite(frame(spark, 2), "gold", "late")
    seen = []
    pins = Lake._pins

    def pins_then_pin(self, *args):
        out = pins(self, *args)
        if not seen:
            until = int(LATER.timestamp() * 1e6) + 10**12
            FileSystem(spark, scratch).create(f"{scratch}/gold/late/_pins/{first.rpartition('/')[2]}~{until}~u", "")
            seen.append(1)
        return out

    monkeypatch.setattr(Lake, "_pins", pins_then_pin)
    assert lake.expire(spark, "gold", "late", now=LATER) == []
    assert spark.read.parquet(first).count() == 1
    assert lake.versions(spark, "gold", "late") != [first]


def test_what_a_dead_writer_left_goes_by_age(spark, scratch):
    lake = Lake(scratch)
    lake.overwrite(frame(spark, 1), "gold", "orphan")
    write_counted(frame(spark, 9), f"{scratch}/gold/orphan/{VERSION}{new_id()}")  # written, never committed
    assert lake.read(spark, "gold", "orphan").count() == 1
    assert lake.expire(spark, "gold", "orphan") == []
    assert len(lake.expire(spark, "gold", "orphan", now=LATER)) == 1
    assert len(FileSystem(spark, scratch).folders(f"{scratch}/gold/orphan")) >= 1 and lake.read(spark, "gold", "orphan").count() == 1


def test_a_table_without_manifests_is_read_and_goes_on(spark, scratch):
    lake = Lake(scratch)
    for n in (3, 4):
        write_counted(frame(spark, n), f"{scratch}/gold/before/{VERSION}{new_id()}")
    assert lake.read(spark, "gold", "before").count() == 4
    lake.overwrite(frame(spark, 5), "gold", "before")
    assert [spark.read.parquet(v).count() for v in lake.versions(spark, "gold", "before")] == [3, 4, 5]
    state = lake._chain(spark, "gold", "before").latest()[1]
    assert json.dumps(state).count(VERSION) == 3


def test_no_version_is_an_error(spark, scratch):
    with pytest.raises(FileNotFoundError):
        Lake(scratch).read(spark, "gold", "none")
    with pytest.raises(FileNotFoundError):
        Lake(scratch).register(spark, "gold", "none")
