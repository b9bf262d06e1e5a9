"""Column expressions as SQL text, for ``selectExpr`` projections.

A wide projection written as SQL strings is analysed in one call instead of a
few JVM round trips per expression node.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from tallyward.specs import DEFAULT_CLAIMS_HOSPITAL, HOSPITALS, PROVIDER_KEY_PATTERN, Hospital

DAY_MS = 86_400_000


def quote(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def surrogate_key(prefix_sql: str, column: str) -> str:
    """``prefix || id``; a NULL id gives a NULL key (``concat`` is NULL-strict)."""
    return f"concat({prefix_sql}, CAST({ident(column)} AS STRING))"


def provider_key(prefix: str, column: str) -> str:
    """Key of ``dim_providers``: only the part of the id from ``PROV`` on. No match gives
    NULL, so such providers never join; facts keep the raw id (the source
    pipeline's asymmetry, kept)."""
    return f"concat({quote(prefix)}, regexp_substr({ident(column)}, {quote(PROVIDER_KEY_PATTERN)}))"


def millis_to_date(column: str) -> str:
    """UTC calendar date of an epoch-millisecond column, by day arithmetic: independent of
    the session time zone."""
    return f"date_from_unix_date(CAST(floor({ident(column)} / {DAY_MS}) AS INT))"


def epoch_millis(column: str, dtype: T.DataType) -> str:
    """Epoch milliseconds of a DATE / TIMESTAMP / TIMESTAMP_NTZ column (the landing form);
    other types pass through."""
    q = ident(column)
    if isinstance(dtype, T.DateType):
        return f"CAST(unix_date({q}) AS BIGINT) * {DAY_MS}"
    if isinstance(dtype, T.TimestampNTZType):
        return f"unix_millis(CAST({q} AS TIMESTAMP))"
    if isinstance(dtype, T.TimestampType):
        return f"unix_millis({q})"
    return q


def run_timestamp(as_of: str) -> str:
    return f"CAST({quote(as_of)} AS TIMESTAMP)"


def run_date(as_of: str) -> str:
    return f"CAST({quote(as_of[:10])} AS DATE)"


def claims_hospital(path_column: str, pick, hospitals: Sequence[Hospital] = HOSPITALS) -> str:
    whens = " ".join(
        f"WHEN {ident(path_column)} LIKE {quote('%' + h.claim_file_tag + '%')} THEN {quote(pick(h))}"
        for h in hospitals
        if h is not DEFAULT_CLAIMS_HOSPITAL
    )
    fallback = quote(pick(DEFAULT_CLAIMS_HOSPITAL))
    return f"CASE {whens} ELSE {fallback} END" if whens else fallback
