"""Plan shape: the properties the design relies on at scale, read from explain()."""

import contextlib
import io
import re

import pytest

from tallyward.plans.queries import all_queries

from conftest import SF_SMALL


def _plan(df, mode="formatted") -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def queries():
    return all_queries()


@pytest.mark.parametrize(
    "name",
    [
        "gold_charge_by_provider_dept",
        "gold_patient_history",
        "gold_provider_performance",
        "gold_department_performance",
        "gold_financial_metrics",
    ],
)
def test_no_join_hints_anywhere(spark, queries, name):
    text = _plan(queries[name](spark, SF_SMALL), "extended")
    logical = text.split("== Physical Plan ==")[0]
    assert "Hint" not in logical  # broadcast decisions are Spark's, by measured size


def test_fact_scan_is_pruned_and_filtered(spark, queries):
    text = _plan(queries["fact_transactions"](spark, SF_SMALL))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert schemas and all("l_quantity" not in s and "l_tax" not in s for s in schemas)
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in text
    assert "Exchange" not in text  # silver is narrow: no shuffle


def test_patient_history_has_no_outer_join_on_transactions(spark, queries):
    text = _plan(queries["gold_patient_history"](spark, SF_SMALL), "extended")
    optimized = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    # outer joins are only the dimension lookups; transactions go inner + anti
    outer = [line for line in optimized.splitlines() if "LeftOuter" in line]
    assert outer and all("enc_provider_key" in line or "enc_dept_key" in line for line in outer)
    assert "LeftAnti" in optimized
    assert re.search(r"Aggregate \[encounter_key", optimized)  # anti join against distinct keys


def test_charge_aggregates_facts_before_the_dimension_joins(spark, queries):
    text = _plan(queries["gold_charge_by_provider_dept"](spark, SF_SMALL), "extended")
    optimized = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    lines = optimized.splitlines()
    agg_depths = [len(line) - len(line.lstrip(" :+-")) for line in lines if "Aggregate [provider_key" in line]
    join_depths = [len(line) - len(line.lstrip(" :+-")) for line in lines if "Join Inner" in line]
    assert agg_depths and join_depths and max(agg_depths) > min(join_depths)


@pytest.mark.parametrize(
    "name,keys",
    [
        ("gold_provider_performance", ("provider_key", "encounter_key")),
        ("gold_department_performance", ("dept_key",)),
        ("gold_financial_metrics", ("transaction_key",)),
    ],
)
def test_distinct_counts_shuffle_on_group_and_value(spark, queries, name, keys):
    text = _plan(queries[name](spark, SF_SMALL))
    parts = re.findall(r"hashpartitioning\(([^)]*)\)", text)
    assert any(all(k in p for k in keys) and len(p.split(",")) > len(keys) - 1 for p in parts), parts


def test_dimensions_fall_back_to_sort_merge_beyond_the_threshold(spark, queries):
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    expected = sorted(map(tuple, queries["gold_charge_by_provider_dept"](spark, SF_SMALL).collect()))
    try:
        for k in keys:
            spark.conf.set(k, "1b")
        df = queries["gold_charge_by_provider_dept"](spark, SF_SMALL)
        got = sorted(map(tuple, df.collect()))
        final = _plan(df, "simple")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "BroadcastHashJoin" not in final and "SortMergeJoin" in final
    assert got == expected


def test_results_do_not_depend_on_physical_choices(spark, queries):
    names = [
        "gold_charge_by_provider_dept",
        "gold_patient_history",
        "gold_provider_performance",
        "gold_department_performance",
        "gold_financial_metrics",
    ]
    baseline = {n: sorted(map(tuple, queries[n](spark, SF_SMALL).collect()), key=repr) for n in names}
    other = {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "37",
    }
    before = {k: spark.conf.get(k, None) for k in other}
    try:
        for k, v in other.items():
            spark.conf.set(k, v)
        for n in names:
            df = queries[n](spark, SF_SMALL)
            # queries re-apply the pipeline settings; force the alternative plan again
            for k, v in other.items():
                spark.conf.set(k, v)
            got = sorted(map(tuple, df.collect()), key=repr)
            assert got == baseline[n], n
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name,scans", [("fact_transactions", 1), ("gold_patient_history", 2), ("gold_financial_metrics", 3)])
def test_scans_of_the_largest_fact(spark, queries, name, scans):
    text = _plan(queries[name](spark, SF_SMALL), "simple")
    assert len(re.findall(r"FileScan parquet.*lineitem\.parquet", text)) == scans
