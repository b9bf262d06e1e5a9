"""The hospital of a claims file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.functions import sql as X
from tallyward.specs import HOSPITALS, Hospital


def claims_hospital_name(path_column: str, hospitals: Sequence[Hospital] = HOSPITALS) -> Column:
    return F.expr(X.claims_hospital(path_column, lambda h: h.name, hospitals))
