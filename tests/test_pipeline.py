"""End-to-end: landing job isolation, and the two-run latest-batch semantics."""

import datetime as dt

import pytest

from tallyward import fixtures
from tallyward.operators.archive import read_archive
from tallyward.plans.landing_job import FixtureSource, land_hospital, name_batch, read_current
from tallyward.plans.refresh import LoadFailed, default_load_config, read_bronze, refresh
from tallyward.schemas import LOAD_CONFIG, landing_schema
from tallyward.sinks.logs import EventLog, read_audit
from tallyward.sources.files import landing_dir, read_load_config
from tallyward.sources.tables import Lake
from tallyward.specs import HOSPITAL_A, HOSPITALS

from conftest import SF_SMALL


def test_one_failing_table_does_not_stop_the_others(spark, scratch):
    lake = Lake(scratch)
    config = spark.createDataFrame(
        [
            ("hospital_a", "hospital_a_db", "departments", "full", "", "1", "x"),
            ("hospital_a", "hospital_a_db", "missing_table", "full", "", "1", "x"),
            ("hospital_a", "hospital_a_db", "providers", "weekly", "", "1", "x"),
            ("hospital_a", "hospital_a_db", "encounters", "incremental", "modifieddate", "1", "x"),
        ],
        LOAD_CONFIG,
    )
    log = EventLog(clock=lambda: dt.datetime(2024, 6, 30))
    rows = land_hospital(
        spark, HOSPITAL_A, FixtureSource(spark, SF_SMALL, HOSPITAL_A), config, lake, dt.datetime(2024, 6, 30), log
    )
    assert sorted(r[1] for r in rows) == ["departments", "encounters"]
    errors = {e[3]: e[2] for e in log.entries if e[1] == "ERROR"}
    assert set(errors) == set(rows.failed) == {"missing_table", "providers"}
    assert "unknown load type" in errors["providers"]
    audit = read_audit(spark, lake.path("control", "audit_log"))
    assert sorted(r.tablename for r in audit.collect()) == ["departments", "encounters"]


def test_second_incremental_run_holds_only_the_delta(spark, scratch):
    lake = Lake(scratch)
    sources = {h.name: FixtureSource(spark, SF_SMALL, h) for h in HOSPITALS}
    claims = fixtures.stage_claim_files(spark, SF_SMALL, f"{scratch}/drops/claims")
    cpt = fixtures.stage_cpt_file(spark, SF_SMALL, f"{scratch}/drops/cpt.csv")
    cfg_path = fixtures.stage_load_config(spark, SF_SMALL, f"{scratch}/configs/load_config.csv", default_load_config(spark))
    config = read_load_config(spark, cfg_path)

    first = refresh(spark, lake, sources, config, claims, cpt, dt.datetime(2024, 6, 30))
    counts1 = {(layer, t): n for layer, t, n in first.counts}
    assert counts1[("silver", "fact_transactions")] > 0

    second = refresh(spark, lake, sources, config, claims, cpt, dt.datetime(2024, 9, 30, 12, 0, 0))
    counts2 = {(layer, t): n for layer, t, n in second.counts}
    # incremental tables: only rows modified after the first run's load time
    assert counts2[("silver", "fact_transactions")] == 0
    assert counts2[("silver", "fact_encounters")] == 0
    cust = fixtures.table(spark, SF_SMALL, "customer")
    # modifieddate = 2024-01-01 + (custkey % 300) days; after 2024-06-30 00:00 means day offset > 181
    a_delta = cust.where("c_custkey % 300 > 181").count()
    b_delta = cust.where("c_custkey % 300 > 181 AND c_custkey % 10 <> 0").count()
    assert counts2[("silver", "dim_patients")] == a_delta + b_delta
    # full tables are reloaded whole
    assert counts2[("silver", "dim_providers")] == counts1[("silver", "dim_providers")]
    # the first batch stays in place as archive
    batches = [b for b, _ in read_current(spark, lake)[("hospital_a_db", "transactions")]]
    own = landing_schema("transactions", HOSPITAL_A, with_load_date=False)
    archived = read_archive(spark, landing_dir(lake.landing, HOSPITAL_A, "transactions"), batches[:-1], own)
    assert len(batches) == 2 and archived.count() == counts1[("landing", "hospital-a/transactions")]
    # the audit log has both runs; the second run's marks are the first run's load time
    audit = read_audit(spark, lake.path("control", "audit_log"))
    assert audit.count() == 20


def test_jobs_cli_runs_land_then_bronze(spark, scratch):
    from tallyward.plans import jobs

    claims = fixtures.stage_claim_files(spark, SF_SMALL, f"{scratch}/drops/claims")
    cpt = fixtures.stage_cpt_file(spark, SF_SMALL, f"{scratch}/drops/cpt.csv")
    cfg = fixtures.stage_load_config(spark, SF_SMALL, f"{scratch}/configs/load_config.csv", default_load_config(spark))
    out = jobs.main(
        ["land", "--lake", f"{scratch}/lake", "--config", cfg, "--hospital", "hospital-b", "--sf-dir", SF_SMALL,
         "--run-ts", "2024-06-30T00:00:00"],
        spark=spark,
    )
    assert sorted(t["table"] for t in out["landed"]) == sorted(fixtures.OPERATIONAL)
    out = jobs.main(["bronze", "--lake", f"{scratch}/lake", "--claims", claims, "--cptcodes", cpt], spark=spark)
    assert out["claims"] == fixtures.claims_rows(spark, SF_SMALL).count() and out["cptcodes"] > 0


def test_scope_all_reads_a_full_table_once_and_the_newest_state_of_a_key(spark, scratch):
    lake = Lake(scratch)
    config = spark.createDataFrame(
        [
            ("hospital_a", "hospital_a_db", "departments", "full", "", "1", "x"),
            ("hospital_a", "hospital_a_db", "patients", "incremental", "modifieddate", "1", "x"),
        ],
        LOAD_CONFIG,
    )
    patients = lambda rows: spark.createDataFrame(
        [(i, n, None, None, None, None, None, None, None, t) for i, n, t in rows],
        "patientid string, firstname string, lastname string, middlename string, ssn string, phonenumber string, gender string, "
        "dob date, address string, modifieddate timestamp",
    )
    departments = spark.createDataFrame([("D1", "Cardio")], "deptid string, name string")
    old, new = dt.datetime(2024, 5, 1), dt.datetime(2024, 6, 1, 12)
    states = {1: [("P1", "Ann", old), ("P2", "Bob", old)], 2: [("P1", "Anna", new), ("P3", "Cy", new), ("P2", "Bob", old)]}
    for day, rows in states.items():
        read = lambda table, rows=rows: departments if table == "departments" else patients(rows)
        land_hospital(spark, HOSPITAL_A, read, config, lake, dt.datetime(2024, 6, day), EventLog())
    names = lambda scope: sorted(r.firstname for r in read_bronze(spark, lake, scope=scope).frames[("hospital-a", "patients")].collect())
    assert names("latest") == ["Anna", "Cy"] and names("all") == ["Anna", "Bob", "Cy"]
    assert read_bronze(spark, lake, scope="all").frames[("hospital-a", "departments")].count() == 1


def _inputs(spark, scratch):
    claims = fixtures.stage_claim_files(spark, SF_SMALL, f"{scratch}/drops/claims")
    cpt = fixtures.stage_cpt_file(spark, SF_SMALL, f"{scratch}/drops/cpt.csv")
    cfg = fixtures.stage_load_config(spark, SF_SMALL, f"{scratch}/configs/load_config.csv", default_load_config(spark))
    return claims, cpt, cfg


def test_cli_layers_on_their_own(spark, scratch):
    from tallyward.plans import jobs

    claims, cpt, cfg = _inputs(spark, scratch)
    lake = ["--lake", f"{scratch}/lake"]
    base = ["refresh", *lake, "--config", cfg, "--claims", claims, "--cptcodes", cpt, "--sf-dir", SF_SMALL]
    rows = lambda out: {(c["layer"], c["table"]): c["rows"] for c in out["counts"]}
    first = rows(jobs.main(base + ["--run-ts", "2024-06-30T00:00:00"], spark=spark))
    second = rows(jobs.main(base + ["--run-ts", "2024-07-01T00:00:00", "--scope", "all"], spark=spark))
    # all batches: the first run's transactions plus an empty second delta; full tables once
    assert second[("silver", "fact_transactions")] == first[("silver", "fact_transactions")]
    assert second[("silver", "dim_departments")] == first[("silver", "dim_departments")]
    # the layers again, without an extract: the latest batch of transactions is empty
    silver = rows(jobs.main(["silver", *lake], spark=spark))
    assert silver[("silver", "fact_transactions")] == 0 and silver[("silver", "dim_departments")] == first[("silver", "dim_departments")]
    jobs.main(["silver", *lake, "--scope", "all"], spark=spark)
    gold = rows(jobs.main(["gold", *lake], spark=spark))
    assert gold[("gold", "patient_history")] == second[("gold", "patient_history")]


class Unreadable(FixtureSource):
    def read(self, table):
        if table == "transactions":
            raise ConnectionError("transactions are unreadable")
        return super().read(table)


def test_a_failed_extract_leaves_silver_and_gold(spark, scratch):
    lake = Lake(f"{scratch}/lake")
    claims, cpt, cfg = _inputs(spark, scratch)
    config = read_load_config(spark, cfg)
    good = {h.name: FixtureSource(spark, SF_SMALL, h) for h in HOSPITALS}
    bad = {h.name: Unreadable(spark, SF_SMALL, h) for h in HOSPITALS}
    first = refresh(spark, lake, good, config, claims, cpt, dt.datetime(2024, 6, 30))
    with pytest.raises(LoadFailed, match="hospital-a/transactions"):
        refresh(spark, lake, bad, config, claims, cpt, dt.datetime(2024, 9, 30))
    for layer, table, n in first.counts:
        if layer in ("silver", "gold"):
            assert lake.read(spark, layer, table).count() == n
    # the next call continues: only transactions are extracted
    third = refresh(spark, lake, good, config, claims, cpt, dt.datetime(2024, 10, 1))
    assert {r[1] for r in third.audit_rows} == {"transactions"}


def test_a_first_load_that_fails_lets_the_others_land(spark, scratch):
    lake = Lake(f"{scratch}/lake")
    claims, cpt, cfg = _inputs(spark, scratch)
    bad = {h.name: Unreadable(spark, SF_SMALL, h) for h in HOSPITALS}
    with pytest.raises(LoadFailed, match="transactions are unreadable"):
        refresh(spark, lake, bad, read_load_config(spark, cfg), claims, cpt, dt.datetime(2024, 6, 30))
    landed = {t for _, t in read_current(spark, lake)}
    assert landed == {"departments", "encounters", "patients", "providers"}
    assert not lake.versions(spark, "silver", "dim_patients")


def test_failed_refresh_keeps_its_events_and_the_retry_has_the_delta(spark, scratch):
    lake = Lake(f"{scratch}/lake")
    claims, cpt, cfg = _inputs(spark, scratch)
    config = read_load_config(spark, cfg)
    sources = {h.name: FixtureSource(spark, SF_SMALL, h) for h in HOSPITALS}
    with pytest.raises(Exception):
        refresh(spark, lake, sources, config, f"{scratch}/no-such-claims/*.csv", cpt, dt.datetime(2024, 6, 30))
    events = spark.read.parquet(lake.path("control", "pipeline_logs")).collect()
    assert any(e.event_type == "ERROR" and "refresh failed" in e.message for e in events)
    assert any(e.event_type == "SUCCESS" and e.table == "departments" for e in events)
    assert len({e.timestamp for e in events}) > len(events) // 2  # the clock of each event
    retry = refresh(spark, lake, sources, config, claims, cpt, dt.datetime(2024, 6, 30, 0, 5))
    counts = {(layer, t): n for layer, t, n in retry.counts}
    assert counts[("silver", "fact_transactions")] == fixtures.table(spark, SF_SMALL, "lineitem").count()
    assert counts[("gold", "patient_history")] > 0


def test_landing_batches_have_names_in_the_catalog(spark, scratch):
    lake = Lake(f"{scratch}/lake")
    config = default_load_config(spark).where("tablename in ('departments', 'patients')")
    for h in HOSPITALS:
        land_hospital(spark, h, FixtureSource(spark, SF_SMALL, h), config, lake, dt.datetime(2024, 6, 30), EventLog())
    for h in HOSPITALS:  # the landing run names its batches; a table without one is named here
        name_batch(spark, lake, h, "providers", None, None)
    bronze = read_bronze(spark, lake)
    for h in HOSPITALS:
        for entity in ("departments", "patients", "providers"):  # providers: no batch yet
            frame = bronze.frames[(h.name, entity)]
            name = f"{h.database.removesuffix('_db')}_{entity}"
            named = spark.table(f"bronze.{name}")
            assert named.columns == frame.columns
            assert sorted(map(str, named.collect())) == sorted(map(str, frame.collect()))
            assert (named.count() > 0) == (entity != "providers")
