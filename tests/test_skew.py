"""A hot key holding a third of all facts: G2's transaction join is split at run
time (AQE skew join), and the answer is unchanged."""

import contextlib
import io

from pyspark.sql import functions as F

from tallyward import fixtures
from tallyward.operators import gold, silver
from tallyward.operators.layers import SilverLayer

AS_OF = "2024-06-30 00:00:00"
SF = "/root/testdata/sf0.01"

SMALL_THRESHOLDS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.shuffle.partitions": "16",
}


def _skewed_silver(spark):
    s = silver.build_silver(fixtures.bronze_layer(spark, SF, AS_OF), AS_OF)
    # as on a cluster, the fact comes from several map tasks (the test file is one task): a
    # skewed partition is split between the outputs of map tasks
    hot = s.transactions.repartition(8).withColumn(
        "encounter_key",
        F.when(F.abs(F.hash("transaction_key")) % 3 == 0, F.lit("HOSP-A-ENC2")).otherwise(F.col("encounter_key")),
    )
    return SilverLayer(
        {
            "departments": lambda: s.departments,
            "encounters": lambda: s.encounters,
            "patients": lambda: s.patients,
            "providers": lambda: s.providers,
            "transactions": lambda: hot,
        }
    )


def test_hot_encounter_is_split_and_rows_are_whole(spark):
    sk = _skewed_silver(spark)
    expected = gold.patient_history(sk, AS_OF).groupBy("encounter_key").count()
    expected_rows = {(r.encounter_key, r["count"]) for r in expected.collect()}

    before = {k: spark.conf.get(k, None) for k in SMALL_THRESHOLDS}
    try:
        for k, v in SMALL_THRESHOLDS.items():
            spark.conf.set(k, v)
        df = gold.patient_history(sk, AS_OF)
        rows = df.collect()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        final = buf.getvalue()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)

    assert "isFinalPlan=true" in final
    assert any("SortMergeJoin(skew=true)" in line and "Inner" in line for line in final.splitlines())
    got = {}
    for r in rows:
        got[r.encounter_key] = got.get(r.encounter_key, 0) + 1
    assert set(got.items()) == expected_rows
    assert got["HOSP-A-ENC2"] > len(rows) // 4  # the hot encounter kept all its rows
