"""Gold layer: five KPI tables over the silver layer.

Plan shape, chosen for large inputs:

* Facts are aggregated *before* they meet a dimension (G1, G3, G4, G5). Money
  sums are exact decimals, so partial sums can be merged in any order; the
  map-side partial aggregate also absorbs hot keys (one provider or one
  department holding a third of all rows costs one partial row per task).
* Joins are equi-joins without hints. Spark broadcasts a side only when its
  estimated size (or, under AQE, its measured shuffle size) is below
  ``autoBroadcastJoinThreshold``; above it the same join runs as a sort-merge
  join. Nothing is broadcast on faith.
* ``COUNT(DISTINCT x)`` shuffles on (group, x), which spreads a hot group across
  tasks.
* G2 is row level. Its encounter→transaction outer join is an inner join (whose skewed
  partitions AQE may split on either side) with the transactions and one row of NULLs for each
  encounter without any, because Spark cannot split the non-preserved side of an outer
  join. Those encounters come from keys alone. Dimension lookups happen on encounter rows,
  before the transaction fan-out, and are planned once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.functions import money, money_cents, money_total, rounded_ratio, run_timestamp
from tallyward.operators.layers import SilverLayer
from tallyward.specs import APPROVED


def _current(dim: DataFrame) -> DataFrame:
    return dim.where(F.col("is_current"))


def charge_by_provider_department(silver: SilverLayer, as_of: str) -> DataFrame:
    """G1 ``total_charge_amount_per_provider_by_department``.

    Department comes from the transaction; groups are by department *name*,
    so same-named departments merge.
    """
    partial = silver.transactions.groupBy("provider_key", "dept_key").agg(
        money_total(F.col("amount")).alias("charge"),
        F.count("transaction_key").alias("n_txn"),
    )
    providers = _current(silver.providers).select(
        "provider_key",
        F.col("firstname").alias("provider_first_name"),
        F.col("lastname").alias("provider_last_name"),
        "specialization",
        "datasource",
    )
    departments = silver.departments.select("dept_key", "dept_name")
    joined = partial.join(providers, "provider_key", "inner").join(departments, "dept_key", "inner")
    return joined.groupBy(
        "provider_key", "provider_first_name", "provider_last_name", "specialization", "dept_name", "datasource"
    ).agg(
        money(F.sum("charge")).alias("total_charge_amount"),
        F.sum("n_txn").alias("total_transactions"),
        run_timestamp(as_of).alias("last_updated_at"),
    )


_TXN_HISTORY_COLUMNS = {
    "icdcode": "diagnosis_code",
    "procedurecode": "procedurecode",
    "amount": "charged_amount",
    "paidamount": "amount_paid",
    "paid_date": "paid_date",
    "amounttype": "payment_method",
}


def patient_history(silver: SilverLayer, as_of: str) -> DataFrame:
    """G2 ``patient_history``: one row per encounter x transaction (an encounter
    without transactions appears once, with NULL transaction columns).

    The provider and department lookups depend only on the encounter, so they run
    on encounter rows, before the transaction fan-out multiplies them.
    """
    patients = _current(silver.patients).select(
        "patient_key",
        "source_patient_id",
        F.concat(F.col("firstname"), F.lit(" "), F.col("lastname")).alias("patient_full_name"),
        "gender",
        F.col("dob").alias("date_of_birth"),
        "datasource",
    )
    encounters = silver.encounters.select(
        "patient_key",
        "encounter_key",
        "encounter_date",
        F.col("encountertype").alias("visit_type"),
        F.col("provider_key").alias("enc_provider_key"),
        F.col("dept_key").alias("enc_dept_key"),
    )
    providers = silver.providers.select(
        F.col("provider_key").alias("enc_provider_key"),
        F.concat(F.col("firstname"), F.lit(" "), F.col("lastname")).alias("provider_name"),
    )
    departments = silver.departments.select(
        F.col("dept_key").alias("enc_dept_key"), F.col("dept_name").alias("department_name")
    )
    visits = (
        patients.join(encounters, "patient_key", "inner")
        .join(providers, "enc_provider_key", "left")
        .join(departments, "enc_dept_key", "left")
    )

    # an encounter without transactions meets one row of NULLs, so visits are planned and shuffled once
    txn = silver.transactions.select(
        F.col("encounter_key").alias("billed_key"), *(F.col(src).alias(dst) for src, dst in _TXN_HISTORY_COLUMNS.items())
    ).where("billed_key IS NOT NULL")
    billed = silver.transactions.select("encounter_key").distinct()
    unbilled = silver.encounters.select("encounter_key").distinct().join(billed, "encounter_key", "left_anti")
    nothing = unbilled.select(F.col("encounter_key").alias("billed_key"), *(F.lit(None).cast(t).alias(c) for c, t in txn.dtypes if c != "billed_key"))
    histories = visits.join(txn.unionByName(nothing), F.col("encounter_key").eqNullSafe(F.col("billed_key")), "inner")
    return histories.select(
        "patient_key",
        "source_patient_id",
        "patient_full_name",
        "gender",
        "date_of_birth",
        "encounter_key",
        "encounter_date",
        "visit_type",
        "provider_name",
        "department_name",
        "diagnosis_code",
        "procedurecode",
        "charged_amount",
        "amount_paid",
        "paid_date",
        "payment_method",
        "datasource",
        run_timestamp(as_of).alias("last_updated_at"),
    )


def _claim_counts(claims: DataFrame, key_cols) -> DataFrame:
    return claims.groupBy(*key_cols).agg(
        F.count("claimid").alias("total_claims"),
        F.count_if(F.col("claimstatus") == F.lit(APPROVED)).alias("approved_claims"),
    )


def provider_performance(silver: SilverLayer, as_of: str) -> DataFrame:
    """G3 ``provider_performance_summary``."""
    encounters = silver.encounters.groupBy("provider_key").agg(
        F.count_distinct("encounter_key").alias("total_encounters")
    )
    financials = silver.transactions.groupBy("provider_key").agg(money_total(F.col("amount")).alias("billed"))
    claims = _claim_counts(silver.claims, ["provider_key"])
    providers = _current(silver.providers)
    joined = (
        providers.join(encounters, "provider_key", "left")
        .join(financials, "provider_key", "left")
        .join(claims, "provider_key", "left")
    )
    return joined.select(
        "provider_key",
        F.col("firstname").alias("provider_first_name"),
        F.col("lastname").alias("provider_last_name"),
        "specialization",
        "datasource",
        F.coalesce(F.col("total_encounters"), F.lit(0).cast("long")).alias("total_encounters"),
        F.coalesce(money(F.col("billed")), F.lit(0.0)).alias("total_billed_amount"),
        F.coalesce(F.col("total_claims"), F.lit(0).cast("long")).alias("total_claims"),
        F.coalesce(F.col("approved_claims"), F.lit(0).cast("long")).alias("total_approved_claims"),
        F.coalesce(
            rounded_ratio(F.col("approved_claims"), F.col("total_claims"), factor=100), F.lit(0.0)
        ).alias("claim_success_rate_percentage"),
        run_timestamp(as_of).alias("last_updated_at"),
    )


def department_performance(silver: SilverLayer, as_of: str) -> DataFrame:
    """G4 ``department_performance_analytics``. Department comes from the
    encounter for volume and from the transaction for money."""
    # an aggregate for each distinct count: together every row would be expanded into two
    encounters = silver.encounters.groupBy("dept_key").agg(F.count_distinct("encounter_key").alias("total_encounters"))
    seen = silver.encounters.groupBy("dept_key").agg(F.count_distinct("patient_key").alias("unique_patients"))
    finance = silver.transactions.groupBy("dept_key").agg(
        money_total(F.col("amount")).alias("billed"),
        money_total(F.col("paidamount")).alias("collected"),
    )
    staffing = (
        _current(silver.providers).groupBy("dept_key").agg(F.count_distinct("provider_key").alias("total_providers"))
    )
    joined = (
        silver.departments.join(encounters, "dept_key", "left")
        .join(seen, "dept_key", "left")
        .join(finance, "dept_key", "left")
        .join(staffing, "dept_key", "left")
    )
    return joined.select(
        "dept_key",
        "dept_name",
        "datasource",
        F.coalesce(F.col("unique_patients"), F.lit(0).cast("long")).alias("patient_volume"),
        F.coalesce(F.col("total_encounters"), F.lit(0).cast("long")).alias("total_encounters"),
        F.coalesce(money(F.col("billed")), F.lit(0.0)).alias("total_billed_amount"),
        F.coalesce(money(F.col("collected")), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(F.col("total_providers"), F.lit(0).cast("long")).alias("provider_count"),
        rounded_ratio(F.col("total_encounters"), F.col("total_providers")).alias("avg_encounters_per_provider"),
        rounded_ratio(money_cents(F.col("collected")), money_cents(F.col("billed")), factor=100).alias(
            "collection_rate_percentage"
        ),
        run_timestamp(as_of).alias("last_updated_at"),
    )


def financial_metrics(silver: SilverLayer, as_of: str) -> DataFrame:
    """G5 ``financial_metrics``: monthly billing (by visit month) full-outer-joined
    to monthly claims (by service month).

    The money sums and the distinct transaction count are separate aggregates,
    joined on the (source, month) key: the sums collapse map-side to one row per
    month, and the distinct count's shuffle carries keys only instead of two
    decimal sum buffers per transaction key.
    """
    month_keys = [F.col("datasource").alias("f_datasource"), F.last_day("visit_date").alias("f_month")]
    sums = silver.transactions.groupBy(*month_keys).agg(
        money_total(F.col("amount")).alias("billed"),
        money_total(F.col("paidamount")).alias("revenue"),
    )
    distinct = silver.transactions.groupBy(*month_keys).agg(
        F.count_distinct("transaction_key").alias("transaction_count")
    )
    # same groups on both sides; the null-safe key keeps a NULL month's row
    billing = sums.join(
        distinct.withColumnsRenamed({"f_datasource": "d_datasource", "f_month": "d_month"}),
        (F.col("f_datasource").eqNullSafe(F.col("d_datasource"))) & (F.col("f_month").eqNullSafe(F.col("d_month"))),
        "inner",
    ).drop("d_datasource", "d_month")
    claims = _claim_counts(
        silver.claims.select(
            F.col("datasource").alias("c_datasource"),
            F.last_day("servicedate").alias("c_month"),
            "claimid",
            "claimstatus",
        ),
        ["c_datasource", "c_month"],
    )
    joined = billing.join(
        claims,
        (F.col("f_datasource") == F.col("c_datasource")) & (F.col("f_month") == F.col("c_month")),
        "full",
    )
    return joined.select(
        F.coalesce("f_datasource", "c_datasource").alias("datasource"),
        F.coalesce("f_month", "c_month").alias("reporting_month"),
        money(F.col("revenue")).alias("total_revenue"),
        money(F.col("billed")).alias("total_billed_amount"),
        "transaction_count",
        money(F.round("billed", 2) - F.round("revenue", 2)).alias("outstanding_balance"),
        "total_claims",
        "approved_claims",
        rounded_ratio(F.col("approved_claims"), F.col("total_claims"), factor=100).alias(
            "claim_success_rate_percentage"
        ),
        run_timestamp(as_of).alias("last_updated_at"),
    )


def financial_metrics_by_month(silver: SilverLayer, as_of: str) -> DataFrame:
    """G5 as it is queried: latest month first (a written table is not sorted)."""
    return financial_metrics(silver, as_of).orderBy(F.col("reporting_month").desc(), F.col("datasource").asc())


GOLD_TABLES = {
    "total_charge_amount_per_provider_by_department": charge_by_provider_department,
    "patient_history": patient_history,
    "provider_performance_summary": provider_performance,
    "department_performance_analytics": department_performance,
    "financial_metrics": financial_metrics,
}


def build_gold(silver: SilverLayer, as_of: str) -> dict[str, DataFrame]:
    return {name: fn(silver, as_of) for name, fn in GOLD_TABLES.items()}
