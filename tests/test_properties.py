"""Property checks against exact Python arithmetic, many cases per Spark job."""

import datetime as dt
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyward.functions import rounded_ratio
from tallyward.functions import sql as X


def _half_away(q: Fraction, scale: int) -> float:
    unit = Fraction(1, 10**scale)
    n = abs(q) / unit
    whole = int(n)
    if n - whole >= Fraction(1, 2):
        whole += 1
    return float((whole if q >= 0 else -whole) * unit)


pairs = st.lists(
    st.tuples(st.integers(-(10**12), 10**12), st.integers(-(10**9), 10**9).filter(lambda d: d != 0)),
    min_size=1,
    max_size=200,
)


@settings(max_examples=15, deadline=None)
@given(pairs)
def test_rounded_ratio_matches_exact_rational_rounding(spark, rows):
    df = spark.createDataFrame(rows, "n long, d long")
    got = [r.v for r in df.select(rounded_ratio(F.col("n"), F.col("d"), factor=100).alias("v")).collect()]
    want = [_half_away(Fraction(n * 100, d), 2) for n, d in rows]
    assert got == want


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(-(10**12), 4 * 10**12), min_size=1, max_size=200))
def test_millis_to_date_matches_utc_calendar(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "ms long")
    got = [r.d for r in df.select(F.expr(X.millis_to_date("ms")).alias("d")).collect()]
    epoch = dt.datetime(1970, 1, 1)
    want = [(epoch + dt.timedelta(milliseconds=v)).date() for v in values]
    assert got == want
