import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tallyward.functions import (
    claims_hospital_name,
    money,
    money_total,
    rounded_ratio,
)
from tallyward.functions import sql as X


def test_surrogate_key_is_null_strict(spark):
    df = spark.createDataFrame([("7",), (None,)], "id string")
    got = [r.k for r in df.select(F.expr(X.surrogate_key("'HOSP-A-'", "id")).alias("k")).collect()]
    assert got == ["HOSP-A-7", None]


def test_provider_key_keeps_only_the_prov_part(spark):
    df = spark.createDataFrame([("H-PROV12",), ("PROV3",), ("X3",), (None,)], "id string")
    got = [r.k for r in df.select(F.expr(X.provider_key("HOSP-B-", "id")).alias("k")).collect()]
    assert got == ["HOSP-B-PROV12", "HOSP-B-PROV3", None, None]


def test_claims_hospital_by_path(spark):
    paths = [("x/hospital1_claim_data.csv",), ("x/hospital10_claim_data.csv",), ("x/hospital2_claim_data.csv",), (None,)]
    df = spark.createDataFrame(paths, "p string")
    rows = df.select(
        F.expr(X.claims_hospital("p", lambda h: h.key_prefix)).alias("k"), claims_hospital_name("p").alias("n")
    ).collect()
    assert [r.k for r in rows] == ["HOSP-A-", "HOSP-A-", "HOSP-B-", "HOSP-B-"]
    assert [r.n for r in rows] == ["hospital-a", "hospital-a", "hospital-b", "hospital-b"]


def test_millis_to_date_is_utc_whatever_the_session_zone(spark):
    df = spark.createDataFrame([(1704067199999,), (1704067200000,), (-1,)], "ms long")
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Bangkok")
        got = [r.d for r in df.select(F.expr(X.millis_to_date("ms")).alias("d")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [dt.date(2023, 12, 31), dt.date(2024, 1, 1), dt.date(1969, 12, 31)]


def test_rounded_ratio_is_exact_half_away_from_zero(spark):
    rows = [(1, 3), (2, 3), (1, 8), (-1, 8), (201, 200), (5, 0), (None, 3), (3, None)]
    df = spark.createDataFrame(rows, "n long, d long")
    pct = [r.v for r in df.select(rounded_ratio(F.col("n"), F.col("d"), factor=100).alias("v")).collect()]
    assert pct == [33.33, 66.67, 12.5, -12.5, 100.5, None, None, None]
    plain = [r.v for r in df.select(rounded_ratio(F.col("n"), F.col("d")).alias("v")).collect()]
    # 201/200 = 1.005 exactly: half away from zero gives 1.01 (a double round could give 1.0)
    assert plain[4] == 1.01
    assert plain[2] == 0.13


def test_money_total_is_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (None,)], "a double")
    row = df.agg(money(money_total(F.col("a"))).alias("m"), money_total(F.col("a")).alias("raw")).first()
    assert row.m == 0.3
    assert row.raw == Decimal("0.3000")
