"""Declared schemas for every source and log table.

Every reader is given a schema: an empty incremental batch then reads as zero
rows instead of an inferred ``struct<>``, and no inference pass is spent on
large inputs.
"""

from __future__ import annotations

from pyspark.sql import types as T

from tallyward.specs import Hospital

S, L, D, DT, TS = T.StringType(), T.LongType(), T.DoubleType(), T.DateType(), T.TimestampType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Landing (bronze) form of the operational tables: dates are epoch milliseconds.
# Column names are the conformed ones; a hospital's own names come from its renames.
LANDING = {
    "departments": _struct(("deptid", S), ("name", S)),
    "encounters": _struct(
        ("encounterid", S), ("patientid", S), ("departmentid", S), ("providerid", S),
        ("encountertype", S), ("procedurecode", S),
        ("encounterdate", L), ("inserteddate", L), ("modifieddate", L),
    ),
    "patients": _struct(
        ("patientid", S), ("firstname", S), ("lastname", S), ("middlename", S),
        ("ssn", S), ("phonenumber", S), ("gender", S), ("dob", L), ("address", S),
        ("modifieddate", L),
    ),
    "providers": _struct(
        ("providerid", S), ("deptid", S), ("firstname", S), ("lastname", S),
        ("specialization", S), ("npi", L),
    ),
    "transactions": _struct(
        ("transactionid", S), ("encounterid", S), ("patientid", S), ("providerid", S),
        ("deptid", S), ("visitdate", L), ("servicedate", L), ("paiddate", L),
        ("insertdate", L), ("modifieddate", L), ("visittype", S), ("amount", D),
        ("amounttype", S), ("paidamount", D), ("claimid", S), ("payorid", S),
        ("procedurecode", S), ("icdcode", S), ("lineofbusiness", S), ("medicaidid", S),
        ("medicareid", S),
    ),
}

# Partition column of the landing folders (one value per load day, ddMMyyyy).
# Declared as a string: inferred, "02012024" would become the integer 2012024.
LOAD_DATE = "load_date"


def landing_schema(entity: str, hospital: Hospital, with_load_date: bool = True) -> T.StructType:
    """Schema of one hospital's landing files for ``entity``, in its own column names."""
    back = {conformed: own for own, conformed in hospital.renames_for(entity).items()}
    fields = [T.StructField(back.get(f.name, f.name), f.dataType, True) for f in LANDING[entity].fields]
    if with_load_date:
        fields.append(T.StructField(LOAD_DATE, S, True))
    return T.StructType(fields)


# Claims CSV: positional (header names are not checked), this order.
CLAIMS = _struct(
    ("claimid", S), ("transactionid", S), ("patientid", S), ("encounterid", S),
    ("providerid", S), ("deptid", S), ("servicedate", DT), ("claimdate", DT),
    ("payorid", S), ("claimamount", D), ("paidamount", D), ("claimstatus", S),
    ("payortype", S), ("deductible", D), ("coinsurance", D), ("copay", D),
    ("insertdate", DT), ("modifieddate", DT),
)

# Procedure-code CSV: positional, this order.
CPTCODES = _struct(
    ("procedure_code_category", S), ("cpt_codes", T.IntegerType()),
    ("procedure_code_descriptions", S), ("code_status", S),
)

# Load control file: read untyped; the first seven fields in this order.
LOAD_CONFIG_COLUMNS = ("database", "datasource", "tablename", "loadtype", "watermark", "is_active", "targetpath")
LOAD_CONFIG = _struct(*((c, S) for c in LOAD_CONFIG_COLUMNS))

# ``batch`` names the landing folder that the row makes current.
AUDIT_LOG = _struct(
    ("data_source", S), ("tablename", S), ("load_type", S), ("record_count", L),
    ("load_timestamp", TS), ("status", S), ("batch", S),
)

# What later runs need of the audit log, one row a table: the mark, and the last batch.
MARKS = T.StructType(
    [
        *_struct(("data_source", S), ("tablename", S), ("latest_timestamp", TS)).fields,
        T.StructField("landed", _struct(("load_timestamp", TS), ("batch", S), ("kind", S), ("record_count", L)), True),
    ]
)

EVENT_LOG = _struct(("timestamp", S), ("event_type", S), ("message", S), ("table", S))
