"""Column expressions shared by the layers. All are built-in Spark functions,
so they stay inside whole-stage code generation."""

from tallyward.functions.dates import run_timestamp
from tallyward.functions.frames import union_all
from tallyward.functions.keys import claims_hospital_name
from tallyward.functions.money import money, money_cents, money_total, rounded_ratio

__all__ = [
    "claims_hospital_name",
    "money",
    "money_cents",
    "money_total",
    "rounded_ratio",
    "run_timestamp",
    "union_all",
]
