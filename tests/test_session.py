"""The shared folder of a session, as a cluster's driver sees it."""

import pytest

from tallyward import session
from tallyward.sources.manifest import FileSystem


class OnCluster:
    """A session whose master is a cluster's."""

    class Conf:
        def __init__(self, conf):
            self._conf = conf

        def get(self, key, *default):
            return "spark://head:7077" if key == "spark.master" else self._conf.get(key, *default)

        def __getattr__(self, name):
            return getattr(self._conf, name)

    def __init__(self, spark):
        self._spark, self.conf = spark, self.Conf(spark.conf)

    def __getattr__(self, name):
        return getattr(self._spark, name)


@pytest.fixture
def cluster(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "shared_root", lambda s, real=session.shared_root: (real(s), f"file:{tmp_path}")[1])
    return OnCluster(spark)


def test_a_file_folder_that_executors_write_to_is_shared(cluster, tmp_path):
    path = session.fresh_dir(cluster, "probe")
    cluster.range(3).write.parquet(path)
    assert cluster.read.parquet(path).count() == 3
    assert not [p.name for p in tmp_path.iterdir() if "trial" in p.name]


def test_a_mounted_checkpoint_folder_is_taken_on_a_cluster(spark):
    session.shared_root(spark)  # names a folder where the session has none
    assert session.shared_root(OnCluster(spark)) == spark.sparkContext.getCheckpointDir()
    assert session.shared_root(OnCluster(spark)).startswith("file:")


def test_a_folder_that_executors_do_not_share_is_an_error(cluster, tmp_path, monkeypatch):
    listed = FileSystem.files
    monkeypatch.setattr(FileSystem, "files", lambda self, path: listed(self, path)[:1])  # the driver sees no more
    with pytest.raises(RuntimeError, match="do not share"):
        session.fresh_dir(cluster, "probe")
    assert not (tmp_path / "tallyward").exists()


def test_audit_rows_without_a_load_time_are_appended(spark, tmp_path):
    from tallyward.plans.io_queries import audit_append

    rows = "SELECT 2L AS user_id, 'view' AS event_type, TIMESTAMP'2024-01-02 03:04:05' AS ts UNION ALL SELECT 4L, 'view', NULL UNION ALL SELECT 3L, NULL, NULL"
    spark.sql(rows).write.parquet(f"{tmp_path}/events.parquet")
    got = audit_append(spark, str(tmp_path)).selectExpr("data_source", "tablename", "record_count", "CAST(load_timestamp AS STRING) AS at").collect()
    assert {tuple(r) for r in got} == {
        ("hospital_a_db", "view", 2, "2024-01-02 03:04:05"),
        ("hospital_a_db", "view", 4, None),
        ("hospital_b_db", None, 3, None),
    }
