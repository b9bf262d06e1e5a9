"""The run's timestamp as a column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyward.functions import sql as X


def run_timestamp(as_of: str) -> Column:
    """The run's timestamp (``CURRENT_TIMESTAMP()`` of the refresh), injected so
    that a refresh is reproducible."""
    return F.expr(X.run_timestamp(as_of))
