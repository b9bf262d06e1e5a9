"""Readers, writers and control operators on hand-written inputs."""

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from tallyward import schemas
from tallyward.operators.control import active_load_specs, select_batch, watermarks_for
from tallyward.sinks.landing import write_landing
from tallyward.sources.files import read_claims_csv, read_cptcodes_csv, read_landing
from tallyward.sources.jdbc import JdbcConnection, ParallelRead, reader_options
from tallyward.specs import HOSPITAL_A, HOSPITAL_B


def _local(path: str) -> str:
    return path.removeprefix("file:")


def _write_text(path: str, text: str) -> str:
    os.makedirs(os.path.dirname(_local(path)), exist_ok=True)
    with open(_local(path), "w") as fh:
        fh.write(text)
    return path


CLAIM_LINE = "C1,T1,P1,E1,PROV1,D1,2024-01-02,2024-01-03,Y,10.5,9.5,Approved,I,1.0,0.1,5.0,2024-01-04,2024-01-05\n"


def test_claims_csv_binds_by_position_and_nulls_bad_cells(spark, scratch):
    header = "transactionid,claimid," + ",".join(f.name for f in schemas.CLAIMS.fields[2:]) + "\n"
    bad = "C2,T2,P2,E2,PROV2,D2,not-a-date,2024-01-03,Y,ten,9.5,Denied,I,1.0,0.1,5.0,2024-01-04,2024-01-05\n"
    path = _write_text(f"{scratch}/claims/hospital1_claim_data.csv", header + CLAIM_LINE + bad)
    rows = {r.claimid: r for r in read_claims_csv(spark, path).collect()}
    assert rows["C1"].transactionid == "T1"  # header names are not used
    assert rows["C1"].servicedate == dt.date(2024, 1, 2) and rows["C1"].claimamount == 10.5
    assert rows["C2"].servicedate is None and rows["C2"].claimamount is None


def test_claims_csv_strict_header_rejects_a_swapped_header(spark, scratch):
    header = "transactionid,claimid," + ",".join(f.name for f in schemas.CLAIMS.fields[2:]) + "\n"
    path = _write_text(f"{scratch}/claims/hospital1_claim_data.csv", header + CLAIM_LINE)
    with pytest.raises(Exception):
        read_claims_csv(spark, path, strict_header=True).collect()


def test_cpt_codes_parse_as_integers_and_keep_multiline_text(spark, scratch):
    text = 'procedure_code_category,cpt_codes,procedure_code_descriptions,code_status\n' \
           'A,00100,"two\nlines",Active\nB,0001F,plain,Active\n'
    path = _write_text(f"{scratch}/cpt/cptcodes.csv", text)
    rows = read_cptcodes_csv(spark, path).orderBy("procedure_code_category").collect()
    assert [(r.cpt_codes, r.procedure_code_descriptions) for r in rows] == [(100, "two\nlines"), (None, "plain")]


def test_landing_keeps_nulls_dates_and_an_empty_batch(spark, scratch):
    landing = f"{scratch}/landing"
    df = spark.createDataFrame(
        [("P1", "Al", None, None, "1", "2", "M", dt.date(1970, 1, 2), "ad", dt.datetime(2024, 1, 1))],
        "patientid string, firstname string, lastname string, middlename string, ssn string, phonenumber string, "
        "gender string, dob date, address string, modifieddate timestamp",
    )
    table_dir = f"{landing}/{HOSPITAL_A.name}/patients"
    assert write_landing(df, table_dir, "b1", "02012024") == 1
    text = open(glob.glob(_local(table_dir) + "/batch=b1/load_date=02012024/*.json")[0]).read()
    assert '"lastname":null' in text and '"dob":86400000' in text and '"modifieddate":1704067200000' in text
    back = read_landing(spark, landing, HOSPITAL_A, "patients", "b1").first()
    assert back.load_date == "02012024" and back.dob == 86_400_000

    empty = spark.createDataFrame([], df.schema)
    assert write_landing(empty, f"{landing}/{HOSPITAL_B.name}/patients", "b1", "02012024") == 0
    for batch in ("b1", None):  # an empty batch, and no batch yet
        again = read_landing(spark, landing, HOSPITAL_B, "patients", batch)
        assert again.count() == 0 and "f_name" in again.columns


def test_select_batch(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)), (3, None)], "id int, modifieddate timestamp"
    )
    assert select_batch(df, "FULL").count() == 3
    inc = select_batch(df, "Incremental", "modifieddate", "2024-01-01 00:00:00")
    assert [r.id for r in inc.collect()] == [2]  # strictly after; NULL never loads
    micros = select_batch(df, "Incremental", "modifieddate", 1_704_067_200_000_000)  # 2024-01-01 UTC
    assert [r.id for r in micros.collect()] == [2]
    with pytest.raises(TypeError):  # it would carry the driver's time zone
        select_batch(df, "incremental", "modifieddate", dt.datetime(2024, 1, 1))
    with pytest.raises(ValueError):
        select_batch(df, "delta")


def test_active_specs_and_default_watermark(spark):
    config = spark.createDataFrame(
        [
            ("h", "hospital_a_db", "encounters", "incremental", "modifieddate", "1", "p"),
            ("h", "hospital_a_db", "patients", "incremental", "modifieddate", "1", "p"),
            ("h", "hospital_a_db", "old", "full", "", "0", "p"),
            ("h", "hospital_b_db", "encounters", "full", "", "1", "p"),
        ],
        schemas.LOAD_CONFIG,
    )
    specs = active_load_specs(config, "hospital_a_db")
    assert sorted(r.tablename for r in specs.collect()) == ["encounters", "patients"]
    audit = spark.createDataFrame(
        [
            ("hospital_a_db", "encounters", "incremental", 5, dt.datetime(2024, 3, 1), "SUCCESS", "b1"),
            ("hospital_a_db", "encounters", "incremental", 5, dt.datetime(2024, 4, 1), "SUCCESS", "b2"),
            ("hospital_b_db", "patients", "incremental", 5, dt.datetime(2024, 5, 1), "SUCCESS", "b1"),
        ],
        schemas.AUDIT_LOG,
    )
    marks = {r.tablename: r.last_watermark for r in watermarks_for(specs, audit).collect()}
    assert marks == {"encounters": dt.datetime(2024, 4, 1), "patients": dt.datetime(1900, 1, 1)}


def test_jdbc_options_are_composed_not_stringified():
    conn = JdbcConnection(url="jdbc:postgresql://db/h", driver="org.postgresql.Driver", properties={"user": "u"})
    opts = reader_options(conn, "encounters", ParallelRead("encounterid_num", "0", "1000000", 16))
    assert opts["dbtable"] == "encounters" and opts["numPartitions"] == "16"
    assert opts["partitionColumn"] == "encounterid_num" and opts["driver"] == "org.postgresql.Driver"


def test_event_rows_have_a_table_column_even_when_null(spark):
    from tallyward.sinks.logs import EventLog

    log = EventLog(clock=lambda: dt.datetime(2024, 1, 1))
    log.log("INFO", "Successfully read the config file")
    df = log.frame(spark)
    assert df.schema["table"].dataType.simpleString() == "string"
    assert df.where(F.col("table").isNull()).count() == 1


def test_a_batch_is_replaced_whole_even_with_dynamic_mode(spark, scratch):
    df = spark.createDataFrame([("D1", "Cardio")], "deptid string, name string")
    table_dir = f"{scratch}/landing/{HOSPITAL_A.name}/departments"
    key = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "dynamic")
        write_landing(df, table_dir, "b1", "01062024")
        write_landing(df, table_dir, "b1", "02062024")  # a retry of the same batch on the next day
    finally:
        spark.conf.set(key, before)
    back = read_landing(spark, f"{scratch}/landing", HOSPITAL_A, "departments", "b1")
    assert [r.load_date for r in back.collect()] == ["02062024"]


def _batch_files(table_dir: str, batch: str) -> list[str]:
    return sorted(f for d, _, names in os.walk(f"{_local(table_dir)}/batch={batch}") for f in (f"{d}/{n}" for n in names) if "part-" in f and not f.endswith(".crc"))


def test_a_run_lands_compressed_files_of_bounded_rows(spark, scratch, monkeypatch):
    from tallyward.operators.control import landed_batches
    from tallyward.plans.landing_job import audit_path, bronze_name, land_hospital
    from tallyward.plans.refresh import default_load_config
    from tallyward.sinks import landing
    from tallyward.sinks.logs import EventLog, read_audit
    from tallyward.sources.files import landing_dir, read_batches
    from tallyward.sources.tables import Lake

    monkeypatch.setattr(landing, "FILE_ROWS", 400, raising=False)
    rows = spark.range(0, 1000, 1, 1).selectExpr("concat('D', id) AS deptid", "CASE WHEN id % 3 = 0 THEN NULL ELSE concat('n\n\"', id) END AS name")
    lake, config = Lake(scratch), default_load_config(spark).where("tablename = 'departments'")
    table_dir = landing_dir(lake.landing, HOSPITAL_A, "departments")
    write_landing(rows.limit(10), table_dir, "plain", "01012024")
    landed = land_hospital(spark, HOSPITAL_A, lambda table: rows, config, lake, dt.datetime(2024, 6, 30), EventLog())
    assert [r[3] for r in landed] == [1000]

    batch = landed_batches(read_audit(spark, audit_path(lake)))[(HOSPITAL_A.database, "departments")][-1][0]
    files = _batch_files(table_dir, batch)
    assert [f.endswith(".json.gz") for f in files] == [True] * 3  # 400, 400 and 200 rows
    plain = write_landing(rows, f"{scratch}/beside", "b1", "01012024")
    size = lambda names: sum(map(os.path.getsize, names))
    assert plain == 1000 and size(files) < size(_batch_files(f"{scratch}/beside", "b1")) / 3

    want = sorted(map(str, rows.collect()))
    schema = schemas.landing_schema("departments", HOSPITAL_A, with_load_date=False)
    assert sorted(map(str, read_landing(spark, lake.landing, HOSPITAL_A, "departments", batch).drop("load_date").collect())) == want
    assert sorted(map(str, spark.table(f"bronze.{bronze_name(HOSPITAL_A, 'departments')}").drop("load_date").collect())) == want
    both = read_batches(spark, table_dir, ["plain", batch], schema)  # batches from before are read with it
    assert both.groupBy("batch").count().orderBy("count").collect() == [("plain", 10), (batch, 1000)]


def _line_items(spark, scratch, n: int) -> str:
    rows = spark.range(0, n, 1, 1).selectExpr(
        "id AS l_orderkey", "id % 7 AS l_partkey", "id % 5 AS l_suppkey", "1 AS l_linenumber", "2.0D AS l_quantity", "id / 4 AS l_extendedprice",
        "0.04D AS l_discount", "0.02D AS l_tax", "element_at(array('A', 'R', 'N', NULL), CAST(id % 4 + 1 AS INT)) AS l_returnflag", "'O' AS l_linestatus",
        "CASE WHEN id % 9 <> 0 THEN TIMESTAMP'1996-02-03 00:00:00' END AS l_shipdate",
    )
    rows.write.parquet(f"{scratch}/tables/lineitem.parquet")
    return f"{scratch}/tables"


def test_claim_files_are_compressed_and_hold_bounded_rows(spark, scratch, monkeypatch):
    from tallyward import fixtures
    from tallyward.sinks import landing

    monkeypatch.setattr(landing, "FILE_ROWS", 400, raising=False)
    sf_dir = _line_items(spark, scratch, 1000)
    found = read_claims_csv(spark, fixtures.stage_claim_files(spark, sf_dir, f"{scratch}/drops/claims"))
    for name in fixtures.CLAIM_FILES:
        files = glob.glob(f"{_local(scratch)}/drops/claims/{name}/part-*")
        assert sorted(f.endswith(".csv.gz") for f in files) == [True] * 2  # 400 and 100 rows
    want = fixtures.claims_rows(spark, sf_dir)
    tagged = found.withColumn("claim_file", F.regexp_extract(F.input_file_name(), "hospital[12]_claim_data.csv", 0))
    assert sorted(map(str, tagged.collect())) == sorted(map(str, want.collect()))


def test_tables_of_the_lake_are_written_with_their_codec(spark, scratch):
    import pyarrow.parquet as pq

    from tallyward.sources.tables import Lake

    lake = Lake(scratch)
    df = spark.range(0, 1000, 1, 1).selectExpr("concat('HOSP-A-TR', id) AS k", "NULLIF(id % 3, 0) AS v")
    assert lake.overwrite(df, "silver", "t") == 1000
    [name] = glob.glob(f"{_local(lake.current(spark, 'silver', 't'))}/part-*.parquet")
    assert {pq.ParquetFile(name).metadata.row_group(0).column(i).compression for i in range(2)} == {"ZSTD"}
    assert sorted(map(str, spark.table("silver.t").collect())) == sorted(map(str, df.collect()))


def test_the_date_of_a_file_name(spark):
    from tallyward.operators.archive import file_date_parts, name_date

    assert name_date("orders_02012024.json") == dt.date(2024, 1, 2)
    for bad in ("orders.json", "orders_31022024.json", "orders_20240102.json", "orders_02012024.csv"):
        with pytest.raises(ValueError):
            name_date(bad)
    names = ["a/b/orders_02012024.json", "a/orders_x_30062024.json", "orders_31022024.json", "a_02012024/orders.json", None]
    parts = file_date_parts(F.col("p"))
    rows = spark.createDataFrame([(n,) for n in names], "p string").select(*(c.alias(n) for n, c in parts.items())).collect()
    assert [tuple(r) for r in rows] == [
        ("2024", "01", "02", "orders_02012024.json"),
        ("2024", "06", "30", "orders_x_30062024.json"),
        (None, None, None, "orders_31022024.json"),
        (None, None, None, "orders.json"),
        (None, None, None, None),
    ]


def test_older_batches_are_read_as_archive(spark, scratch):
    from tallyward.operators.archive import read_archive

    table_dir = f"{scratch}/landing/{HOSPITAL_A.name}/departments"
    schema = schemas.landing_schema("departments", HOSPITAL_A, with_load_date=False)
    for batch, day, name in (("b1", "30062024", "Cardio"), ("b2", "01072024", "Lab"), ("b3", "02072024", "Eye")):
        write_landing(spark.createDataFrame([("D1", name)], "deptid string, name string"), table_dir, batch, day)
    rows = read_archive(spark, table_dir, ["b1", "b2"], schema).collect()
    assert sorted(map(tuple, rows)) == [("D1", "Cardio", "2024", "06", "30", "b1"), ("D1", "Lab", "2024", "07", "01", "b2")]
    assert read_archive(spark, table_dir, [], schema).count() == 0


def test_a_failed_write_leaves_the_table_and_replaced_versions_go_by_age(spark, scratch):
    from tallyward.sources.tables import Lake

    lake = Lake(scratch)
    frame = lambda n: spark.range(n).toDF("x")
    for n in (3, 4, 5, 6):
        assert lake.overwrite(frame(n), "gold", "t") == n
    assert len(lake.versions(spark, "gold", "t")) == 4  # all were replaced just now
    later = dt.datetime.now(dt.timezone.utc) + dt.timedelta(days=8)
    assert len(lake.expire(spark, "gold", "t", now=later)) == 3 and len(lake.versions(spark, "gold", "t")) == 1
    with pytest.raises(Exception):
        lake.overwrite(frame(9).select(F.raise_error(F.lit("lost")).alias("x")), "gold", "t")
    assert lake.read(spark, "gold", "t").count() == 6
    lake.register(spark, "gold", "t")
    assert spark.table("gold.t").count() == 6
    with pytest.raises(FileNotFoundError):
        lake.read(spark, "gold", "missing")


ZONES = """
import datetime as dt, sys
sys.path.insert(0, {repo!r})
from tallyward.session import build_session
from tallyward.plans.landing_job import land_hospital, read_current
from tallyward.schemas import LOAD_CONFIG
from tallyward.sinks.logs import EventLog
from tallyward.sources.files import read_landing
from tallyward.sources.tables import Lake
from tallyward.specs import HOSPITAL_A as H
spark = build_session(master="local[2]", shuffle_partitions=2, app_name="zones")
lake = Lake({root!r})
config = spark.createDataFrame([("h", H.database, "departments", "incremental", "modifieddate", "1", "x")], LOAD_CONFIG)
rows = spark.sql("SELECT concat('D', h) AS deptid, 'n' AS name, timestamp_micros(1717200000000000 + h * 3600000000L) AS modifieddate FROM (SELECT explode(sequence(1, 12)) AS h)")
for h in (5, 11):  # 2024-06-01 05:00 and 11:00 UTC
    seen = rows.where(f"modifieddate <= timestamp_micros(1717200000000000 + {{h}} * 3600000000L)")
    land_hospital(spark, H, lambda table: seen, config, lake, dt.datetime(2024, 6, 1, h, 30, tzinfo=dt.timezone.utc), EventLog())
last = read_current(spark, lake)[(H.database, "departments")][-1][0]
print("ROWS", sorted(r.deptid for r in read_landing(spark, lake.landing, H, "departments", last).collect()))
"""


@pytest.mark.parametrize("zone", ["UTC", "Asia/Ho_Chi_Minh", "America/New_York"])
def test_the_watermark_does_not_move_with_the_drivers_zone(scratch, zone, tmp_path):
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = ZONES.format(repo=repo, root=str(tmp_path / "lake"))
    out = subprocess.run([sys.executable, "-c", code], env={**os.environ, "TZ": zone}, capture_output=True, text=True, timeout=240)
    lines = [line for line in out.stdout.splitlines() if line.startswith("ROWS")]
    assert lines == ["ROWS ['D10', 'D11', 'D6', 'D7', 'D8', 'D9']"], out.stderr[-2000:]
