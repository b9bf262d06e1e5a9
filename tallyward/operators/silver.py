"""Silver layer: conformed dimensions and facts across hospitals.

Every table is a projection of each hospital's bronze table followed by a
``UNION ALL`` — narrow operations only, so a silver table is one scan stage
with no shuffle. Snapshot semantics: each refresh replaces the tables; the
slowly-changing-dimension columns are filled (valid_from / valid_to NULL /
is_current TRUE) but no history is merged.

Projections are SQL expression lists (``selectExpr``) built from the hospital
spec: one analysis call per projection.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tallyward.functions import sql as X
from tallyward.functions.frames import union_all
from tallyward.operators.layers import HOSPITAL_COLUMN, BronzeLayer, SilverLayer
from tallyward.specs import HOSPITALS, Hospital


class AllHospitals:
    """Stands for the hospital of a row in a frame of all hospitals: prefix and name are
    looked up by the row's ``hospital_name``."""

    def __init__(self, hospitals):
        whens = " ".join(f"WHEN {X.quote(h.name)} THEN {X.quote(h.key_prefix)}" for h in hospitals)
        self.prefix_sql = f"CASE {HOSPITAL_COLUMN} {whens} END"
        self.name_sql = HOSPITAL_COLUMN


def _per_hospital(bronze: BronzeLayer, entity: str, exprs) -> DataFrame:
    if entity in bronze.combined:  # one scan for all hospitals
        return bronze.combined[entity].selectExpr(*exprs(AllHospitals(bronze.hospitals)))
    return union_all(bronze.conformed(h, entity).selectExpr(*exprs(h)) for h in bronze.hospitals)


def _key(h: Hospital | AllHospitals, column: str, alias: str) -> str:
    prefix = h.prefix_sql if isinstance(h, AllHospitals) else X.quote(h.key_prefix)
    return f"{X.surrogate_key(prefix, column)} AS {alias}"


def _day(column: str, alias: str) -> str:
    return f"{X.millis_to_date(column)} AS {alias}"


def _source(h: Hospital | AllHospitals) -> str:
    return f"{h.name_sql if isinstance(h, AllHospitals) else X.quote(h.name)} AS datasource"


def _ingested(as_of: str, alias: str = "ingestion_at") -> str:
    return f"{X.run_timestamp(as_of)} AS {alias}"


def dim_departments(bronze: BronzeLayer, as_of: str) -> DataFrame:
    return _per_hospital(
        bronze,
        "departments",
        lambda h: [
            _key(h, "deptid", "dept_key"),
            "deptid AS dept_id",
            "name AS dept_name",
            _source(h),
            _ingested(as_of),
        ],
    )


def fact_encounters(bronze: BronzeLayer, as_of: str) -> DataFrame:
    return _per_hospital(
        bronze,
        "encounters",
        lambda h: [
            _key(h, "encounterid", "encounter_key"),
            _key(h, "patientid", "patient_key"),
            _key(h, "departmentid", "dept_key"),
            _key(h, "providerid", "provider_key"),
            "encounterid",
            "encountertype",
            "procedurecode",
            _day("encounterdate", "encounter_date"),
            _day("inserteddate", "inserted_date"),
            _day("modifieddate", "modified_date"),
            _source(h),
            _ingested(as_of),
        ],
    )


def dim_patients(bronze: BronzeLayer, as_of: str) -> DataFrame:
    return _per_hospital(
        bronze,
        "patients",
        lambda h: [
            _key(h, "patientid", "patient_key"),
            "patientid AS source_patient_id",
            "firstname",
            "lastname",
            "middlename",
            "ssn",
            "phonenumber",
            "gender",
            _day("dob", "dob"),
            "address",
            _source(h),
            _day("modifieddate", "valid_from"),
            "CAST(NULL AS DATE) AS valid_to",
            "TRUE AS is_current",
            _ingested(as_of),
        ],
    )


def dim_providers(bronze: BronzeLayer, as_of: str) -> DataFrame:
    """Provider key = prefix + the part of the id from ``PROV`` on (NULL when the
    id has none); facts keep the raw id, so such providers never join."""
    return _per_hospital(
        bronze,
        "providers",
        lambda h: [
            f"{X.provider_key(h.key_prefix, 'providerid')} AS provider_key",
            _key(h, "deptid", "dept_key"),
            "providerid AS source_provider_id",
            "firstname",
            "lastname",
            "specialization",
            "npi",
            _source(h),
            f"{X.run_date(as_of)} AS valid_from",
            "CAST(NULL AS DATE) AS valid_to",
            "TRUE AS is_current",
            _ingested(as_of),
        ],
    )


_TXN_PASS_THROUGH = (
    "visittype", "amount", "amounttype", "paidamount", "claimid", "payorid",
    "procedurecode", "icdcode", "lineofbusiness", "medicaidid", "medicareid",
)


def fact_transactions(bronze: BronzeLayer, as_of: str) -> DataFrame:
    return _per_hospital(
        bronze,
        "transactions",
        lambda h: [
            _key(h, "transactionid", "transaction_key"),
            _key(h, "encounterid", "encounter_key"),
            _key(h, "patientid", "patient_key"),
            _key(h, "providerid", "provider_key"),
            _key(h, "deptid", "dept_key"),
            _day("visitdate", "visit_date"),
            _day("servicedate", "service_date"),
            _day("paiddate", "paid_date"),
            _day("insertdate", "insert_date"),
            _day("modifieddate", "modified_date"),
            *_TXN_PASS_THROUGH,
            _source(h),
            _ingested(as_of),
        ],
    )


def dim_cptcodes(cptcodes: DataFrame) -> DataFrame:
    return cptcodes.select(
        "cpt_codes", "procedure_code_descriptions", "procedure_code_category", "code_status", "extraction_timestamp"
    )


_CLAIM_PASS_THROUGH = (
    "servicedate", "claimdate", "payorid", "claimamount", "paidamount", "claimstatus",
    "payortype", "deductible", "coinsurance", "copay", "insertdate", "modifieddate",
)


def fact_claims(claims: DataFrame, hospitals=HOSPITALS) -> DataFrame:
    """Claims arrive in one table for all hospitals; the file a claim came from
    tells its hospital (a path without a known tag, NULL included, goes to the
    default hospital)."""
    prefix = X.claims_hospital("source_file_path", lambda h: h.key_prefix, hospitals)
    return claims.selectExpr(
        "claimid",
        *(
            f"{X.surrogate_key(prefix, col)} AS {alias}"
            for col, alias in (
                ("transactionid", "transaction_key"),
                ("patientid", "patient_key"),
                ("encounterid", "encounter_key"),
                ("providerid", "provider_key"),
                ("deptid", "dept_key"),
            )
        ),
        *_CLAIM_PASS_THROUGH,
        "source_file_path",
        f"{X.claims_hospital('source_file_path', lambda h: h.name, hospitals)} AS datasource",
        "extraction_timestamp AS ingestion_at",
    )


def build_silver(bronze: BronzeLayer, as_of: str) -> SilverLayer:
    """The silver layer as lazy plans over ``bronze``."""
    builders = {
        "departments": lambda: dim_departments(bronze, as_of),
        "encounters": lambda: fact_encounters(bronze, as_of),
        "patients": lambda: dim_patients(bronze, as_of),
        "providers": lambda: dim_providers(bronze, as_of),
        "transactions": lambda: fact_transactions(bronze, as_of),
    }
    if bronze.has_file("cptcodes"):
        builders["cptcodes"] = lambda: dim_cptcodes(bronze.cptcodes)
    if bronze.has_file("claims"):
        builders["claims"] = lambda: fact_claims(bronze.claims, bronze.hospitals)
    return SilverLayer(builders)
