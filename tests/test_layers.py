"""Silver and gold on hand-written rows: one test per semantic rule."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from tallyward import schemas
from tallyward.operators import gold, silver
from tallyward.operators.layers import BronzeLayer
from tallyward.specs import HOSPITAL_A, HOSPITAL_B

AS_OF = "2024-06-30 00:00:00"
DAY = 86_400_000
D0 = 19723 * DAY  # 2024-01-01


def _frame(spark, entity, hospital, rows):
    return spark.createDataFrame(rows, schemas.landing_schema(entity, hospital, with_load_date=False))


@pytest.fixture
def bronze(spark):
    frames = {
        ("hospital-a", "departments"): _frame(spark, "departments", HOSPITAL_A, [("D1", "Cardio"), ("D2", "Cardio"), ("D3", "Empty")]),
        ("hospital-b", "departments"): _frame(spark, "departments", HOSPITAL_B, [("D1", "Cardio")]),
        ("hospital-a", "providers"): _frame(
            spark,
            "providers",
            HOSPITAL_A,
            [("H-PROV1", "D1", "Ann", "Lee", "S1", 1), ("X9", "D1", "Bob", "Ray", "S2", 9), ("PROV2", "D2", "Cy", "Fu", "S3", 2)],
        ),
        ("hospital-b", "providers"): _frame(spark, "providers", HOSPITAL_B, [("PROV1", "D1", "Dee", "Oh", "S1", 1)]),
        ("hospital-a", "patients"): _frame(
            spark,
            "patients",
            HOSPITAL_A,
            [("P1", "Al", "Smith", None, "1", "2", "M", 0, "ad", D0), ("P2", "Bo", None, None, "3", "4", "F", DAY, "ad", D0)],
        ),
        ("hospital-b", "patients"): _frame(
            spark, "patients", HOSPITAL_B, [("P1", "Cy", "Jones", "Q", "5", "6", "F", -DAY, "ad", D0 + DAY)]
        ),
        ("hospital-a", "encounters"): _frame(
            spark,
            "encounters",
            HOSPITAL_A,
            [
                ("E1", "P1", "D1", "PROV1", "in", "100", D0, D0, D0),
                ("E2", "P1", "D2", "PROV2", "out", "101", D0 + 40 * DAY, D0, D0),
                ("E3", "P2", "D9", "PROV7", "out", "102", D0, D0, D0),
            ],
        ),
        ("hospital-b", "encounters"): _frame(spark, "encounters", HOSPITAL_B, []),
        ("hospital-a", "transactions"): _frame(
            spark,
            "transactions",
            HOSPITAL_A,
            [
                ("T1", "E1", "P1", "PROV1", "D1", D0, D0, D0, D0, D0, "v", 100.005, "A", 90.0, "C1", "Y", "1", "I", "L", "m", "m"),
                ("T2", "E1", "P1", "PROV1", "D2", D0, D0, D0, D0, D0, "v", 50.0, "A", 50.0, "C2", "Y", "1", "I", "L", "m", "m"),
                ("T3", "E2", "P1", "PROV2", "D3", D0 + 40 * DAY, D0, D0, D0, D0, "v", 10.0, "R", 0.0, "C3", "Y", "1", "I", "L", "m", "m"),
            ],
        ),
        ("hospital-b", "transactions"): _frame(spark, "transactions", HOSPITAL_B, []),
    }
    claims = spark.createDataFrame(
        [
            ("C1", "T1", "P1", "E1", "PROV1", "D1", dt.date(2024, 1, 5), None, "Y", 100.0, 90.0, "Approved", "I", 0.0, 0.0, 0.0, None, None, "x/hospital1_claim_data.csv", dt.datetime(2024, 6, 30)),
            ("C2", "T2", "P1", "E1", "PROV1", "D1", dt.date(2024, 1, 6), None, "Y", 100.0, 90.0, "Denied", "I", 0.0, 0.0, 0.0, None, None, "x/hospital1_claim_data.csv", dt.datetime(2024, 6, 30)),
            ("C9", "T9", "P9", "E9", "PROV1", "D1", dt.date(2024, 3, 6), None, "Y", 5.0, 5.0, "Approved", "I", 0.0, 0.0, 0.0, None, None, None, dt.datetime(2024, 6, 30)),
        ],
        T.StructType(
            schemas.CLAIMS.fields
            + [T.StructField("source_file_path", T.StringType()), T.StructField("extraction_timestamp", T.TimestampType())]
        ),
    )
    return BronzeLayer(frames=frames, claims=claims)


def test_silver_conforms_hospital_b_patient_columns(spark, bronze):
    p = silver.dim_patients(bronze, AS_OF)
    rows = {r.patient_key: r for r in p.collect()}
    assert rows["HOSP-B-P1"].firstname == "Cy" and rows["HOSP-B-P1"].middlename == "Q"
    assert rows["HOSP-B-P1"].dob == dt.date(1969, 12, 31)
    assert rows["HOSP-A-P1"].valid_from == dt.date(2024, 1, 1)
    assert rows["HOSP-A-P1"].valid_to is None and rows["HOSP-A-P1"].is_current is True


def test_silver_provider_key_is_normalised_only_in_the_dimension(spark, bronze):
    keys = sorted((r.provider_key or "-", r.source_provider_id) for r in silver.dim_providers(bronze, AS_OF).collect())
    assert keys == [("-", "X9"), ("HOSP-A-PROV1", "H-PROV1"), ("HOSP-A-PROV2", "PROV2"), ("HOSP-B-PROV1", "PROV1")]
    enc = {r.encounter_key: r.provider_key for r in silver.fact_encounters(bronze, AS_OF).collect()}
    assert enc["HOSP-A-E1"] == "HOSP-A-PROV1"


def test_fact_claims_hospital_comes_from_the_file_path(spark, bronze):
    rows = {r.claimid: r for r in silver.fact_claims(bronze.claims).collect()}
    assert rows["C1"].transaction_key == "HOSP-A-T1" and rows["C1"].datasource == "hospital-a"
    assert rows["C9"].transaction_key == "HOSP-B-T9" and rows["C9"].datasource == "hospital-b"  # NULL path → B


def test_gold_charge_merges_same_named_departments(spark, bronze):
    s = silver.build_silver(bronze, AS_OF)
    rows = {(r.provider_key, r.dept_name): r for r in gold.charge_by_provider_department(s, AS_OF).collect()}
    # T1 (D1) and T2 (D2) are both in a department named Cardio
    r = rows[("HOSP-A-PROV1", "Cardio")]
    assert r.total_transactions == 2 and r.total_charge_amount == 150.01
    assert rows[("HOSP-A-PROV2", "Empty")].total_charge_amount == 10.0


def test_gold_provider_performance_fills_zeros(spark, bronze):
    s = silver.build_silver(bronze, AS_OF)
    rows = {(r.provider_key, r.datasource): r for r in gold.provider_performance(s, AS_OF).collect()}
    a1 = rows[("HOSP-A-PROV1", "hospital-a")]
    assert (a1.total_encounters, a1.total_claims, a1.total_approved_claims) == (1, 2, 1)
    assert a1.claim_success_rate_percentage == 50.0
    none = rows[(None, "hospital-a")]  # provider whose id has no PROV part
    assert (none.total_encounters, none.total_billed_amount, none.total_claims) == (0, 0.0, 0)
    b1 = rows[("HOSP-B-PROV1", "hospital-b")]
    assert b1.claim_success_rate_percentage == 100.0  # C9 came from a NULL path → B


def test_gold_department_performance_null_ratios(spark, bronze):
    s = silver.build_silver(bronze, AS_OF)
    rows = {r.dept_key: r for r in gold.department_performance(s, AS_OF).collect()}
    d1 = rows["HOSP-A-D1"]
    assert (d1.patient_volume, d1.total_encounters, d1.provider_count) == (1, 1, 1)
    assert d1.avg_encounters_per_provider == 1.0
    assert d1.collection_rate_percentage == 89.99  # 90.00 collected of 100.01 billed
    d3 = rows["HOSP-A-D3"]
    assert d3.provider_count == 0 and d3.avg_encounters_per_provider is None
    assert d3.collection_rate_percentage == 0.0  # 0 collected of 10 billed
    empty_b = rows["HOSP-B-D1"]
    assert empty_b.total_billed_amount == 0.0 and empty_b.collection_rate_percentage is None


def test_gold_financial_metrics_full_outer_and_order(spark, bronze):
    s = silver.build_silver(bronze, AS_OF)
    rows = gold.financial_metrics_by_month(s, AS_OF).collect()
    keys = [(r.datasource, r.reporting_month) for r in rows]
    assert keys == [
        ("hospital-b", dt.date(2024, 3, 31)),
        ("hospital-a", dt.date(2024, 2, 29)),
        ("hospital-a", dt.date(2024, 1, 31)),
    ]
    claim_only = rows[0]
    assert claim_only.total_billed_amount is None and claim_only.total_claims == 1
    jan = rows[2]
    assert jan.transaction_count == 2 and jan.total_claims == 2 and jan.approved_claims == 1
    assert jan.outstanding_balance == round(150.01 - 140.0, 2)


def test_patient_history_keeps_encounters_without_transactions(spark, bronze):
    s = silver.build_silver(bronze, AS_OF)
    rows = gold.patient_history(s, AS_OF).collect()
    by_enc = {}
    for r in rows:
        by_enc.setdefault(r.encounter_key, []).append(r)
    assert len(by_enc["HOSP-A-E1"]) == 2
    e3 = by_enc["HOSP-A-E3"]
    assert len(e3) == 1 and e3[0].charged_amount is None and e3[0].provider_name is None
    assert e3[0].patient_full_name is None  # NULL last name → NULL full name
    assert by_enc["HOSP-A-E1"][0].provider_name == "Ann Lee"


def test_financial_metrics_null_months_never_match(spark):
    from tallyward.operators.layers import SilverLayer

    txn = spark.createDataFrame(
        [("hospital-a", None, 10.0, 9.0, "K1"), ("hospital-a", dt.date(2024, 1, 3), 5.0, 5.0, "K2")],
        "datasource string, visit_date date, amount double, paidamount double, transaction_key string",
    )
    claims = spark.createDataFrame(
        [("hospital-a", None, "C1", "Approved"), ("hospital-a", dt.date(2024, 1, 9), "C2", "Denied")],
        "datasource string, servicedate date, claimid string, claimstatus string",
    )
    s = SilverLayer({"transactions": lambda: txn, "claims": lambda: claims})
    rows = gold.financial_metrics_by_month(s, AS_OF).collect()
    assert [(r.reporting_month, r.transaction_count, r.total_claims) for r in rows] == [
        (dt.date(2024, 1, 31), 1, 1),
        (None, 1, None),
        (None, None, 1),
    ] or [(r.reporting_month, r.transaction_count, r.total_claims) for r in rows] == [
        (dt.date(2024, 1, 31), 1, 1),
        (None, None, 1),
        (None, 1, None),
    ]
    jan = rows[0]
    assert jan.claim_success_rate_percentage == 0.0 and jan.outstanding_balance == 0.0


def test_patient_history_keeps_encounters_without_key_or_transaction(spark):
    """NULL encounter keys, repeated keys without transactions, and transactions without a key."""
    from tallyward.operators.gold import patient_history
    from tallyward.operators.layers import SilverLayer

    sql = spark.sql
    frames = {
        "patients": lambda: sql("SELECT 'P' AS patient_key, 's' AS source_patient_id, 'a' AS firstname, 'b' AS lastname, 'F' AS gender, DATE'2000-01-01' AS dob, 'h' AS datasource, TRUE AS is_current"),
        "encounters": lambda: sql("SELECT 'P' AS patient_key, k AS encounter_key, DATE'2024-01-01' AS encounter_date, t AS encountertype, 'v' AS provider_key, 'd' AS dept_key FROM VALUES ('E1', 'x'), ('E2', 'y'), ('E2', 'z'), (CAST(NULL AS STRING), 'n'), (NULL, 'm') AS e(k, t)"),
        "providers": lambda: sql("SELECT 'v' AS provider_key, 'f' AS firstname, 'l' AS lastname"),
        "departments": lambda: sql("SELECT 'd' AS dept_key, 'D' AS dept_name"),
        "transactions": lambda: sql("SELECT k AS encounter_key, 'i' AS icdcode, 'p' AS procedurecode, a AS amount, a AS paidamount, DATE'2024-01-02' AS paid_date, 'c' AS amounttype FROM VALUES ('E1', 1.0D), ('E1', 2.0D), (CAST(NULL AS STRING), 3.0D), ('E9', 4.0D) AS t(k, a)"),
    }
    got = patient_history(SilverLayer(frames), "2024-06-30 00:00:00").collect()
    key = lambda r: (r.encounter_key or "", r.visit_type, r.charged_amount or 0.0)
    assert sorted(map(key, got)) == [("", "m", 0.0), ("", "n", 0.0), ("E1", "x", 1.0), ("E1", "x", 2.0), ("E2", "y", 0.0), ("E2", "z", 0.0)]
