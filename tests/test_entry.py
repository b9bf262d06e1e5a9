"""The driver contract: entry runs, every query has a name-matched oracle."""

import __spark_entry__ as entry_mod

# Operators without a database-free way to run: see README ("Not registered").
NO_ORACLE: set[str] = set()


def test_entry_runs_on_the_smallest_tables(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert "claim_success_rate_percentage" in df.columns


def test_every_query_of_the_medallion_has_an_oracle():
    """Training-data operators are another matter: what SQL can't express is held against
    brute force in tests/llm."""
    from tallyward.plans.oracle_map import all_oracles
    from tallyward.plans.queries import all_queries

    qs, sqls = entry_mod.queries(), entry_mod.oracle_sql()
    assert set(all_queries()) - set(all_oracles()) == NO_ORACLE
    assert set(all_queries()) <= set(qs)
    assert set(sqls) <= set(qs)


def test_every_test_file_has_a_name_of_its_own():
    """Two files of one name in different folders are not collected together."""
    import collections
    import pathlib

    names = collections.Counter(p.name for p in pathlib.Path(__file__).parent.rglob("*.py"))
    assert max(names.values()) == 1, [n for n, k in names.items() if k > 1]
