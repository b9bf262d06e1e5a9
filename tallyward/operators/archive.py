"""The date that a landing file carries, and the archive of older batches.

Landing batches are immutable folders. The batch that the audit log names last is the
current one; all that it named before are the archive, which is read in place under
year, month, day and batch. Nothing is moved or copied, whatever a batch's size.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyward.schemas import LOAD_DATE
from tallyward.sources.files import read_batches

# A landing file is named <table>_<ddMMyyyy>.json.
NAME_PATTERN = r"_(\d{8})\.json$"
DATE_FORMAT = "ddMMyyyy"


def _parts(date: Column) -> dict[str, Column]:
    return {
        "year": F.date_format(date, "yyyy"),
        "month": F.date_format(date, "MM"),
        "day": F.date_format(date, "dd"),
    }


def file_date(path: Column) -> Column:
    """C4: the date in a landing file's name; NULL where the name carries none."""
    return F.try_to_timestamp(F.nullif(F.regexp_extract(path, NAME_PATTERN, 1), F.lit("")), F.lit(DATE_FORMAT)).cast("date")


def file_date_parts(path: Column) -> dict[str, Column]:
    """C4: year, month, day (text, NULL where the name carries no date) and file name."""
    return {**_parts(file_date(path)), "filename": F.regexp_extract(path, r"([^/]*)$", 1)}


def name_date(name: str) -> dt.date:
    """C4 on one file name (driver side); a name without a date is an error."""
    stem, dot, kind = name.rpartition(".")
    try:
        if kind != "json":
            raise ValueError
        return dt.datetime.strptime(stem.rpartition("_")[2], "%d%m%Y").date()
    except ValueError:
        raise ValueError(f"{name!r} carries no ddMMyyyy date") from None


def read_archive(spark: SparkSession, table_dir: str, batches: Sequence[str], schema: T.StructType) -> DataFrame:
    """The archived batches of one table, typed, with year, month, day and batch."""
    rows = read_batches(spark, table_dir, batches, schema)
    parts = _parts(F.try_to_timestamp(F.col(LOAD_DATE), F.lit(DATE_FORMAT)).cast("date"))
    return rows.select(*schema.fieldNames(), *(c.alias(n) for n, c in parts.items()), "batch")
