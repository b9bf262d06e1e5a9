"""Oracle SQL for each registered query (same keys as ``plans.queries``)."""

from __future__ import annotations

from tallyward import oracles


def all_oracles() -> dict[str, str]:
    out = {name: oracles.silver_sql(name) for name in oracles.SILVER_CTES}
    out.update({name: oracles.medallion_sql(sql) for name, sql in oracles.GOLD_SQL.items()})
    out.update(oracles.io_sql())
    return out
