"""Independent DuckDB SQL for every registered query.

Written straight from the table definitions (joins first, then aggregates, no
pre-aggregation tricks), over the same parquet tables the Spark queries read.
The fixture mapping of ``tallyward.fixtures`` is restated here in SQL.

DuckDB differences respected: ``concat`` skips NULLs (use ``||``);
``regexp_extract`` gives '' on no match (wrap in NULLIF); ``count_if`` is
HUGEINT (cast to BIGINT); exact integer division on HUGEINT (``//``).
"""

from __future__ import annotations

AS_OF = "2024-06-30 00:00:00"
TS = f"TIMESTAMP '{AS_OF}'"
DAY_MS = 86_400_000


def ratio_sql(num: str, den: str, scale: int = 2, factor: int = 1) -> str:
    """Exact ``ROUND(num*factor/den, scale)``, half away from zero; NULL on 0."""
    mult = 2 * factor * 10**scale
    n = f"abs(CAST({num} AS HUGEINT))"
    d = f"abs(CAST({den} AS HUGEINT))"
    q = f"(({n} * {mult} + {d}) // (2 * {d}))"
    signed = f"(CASE WHEN (({num}) < 0) <> (({den}) < 0) THEN -{q} ELSE {q} END)"
    return f"(CASE WHEN ({den}) <> 0 THEN CAST({signed} AS DOUBLE) / CAST({10**scale} AS DOUBLE) END)"


def money_sql(col: str) -> str:
    return f"CAST(round(SUM(CAST({col} AS DECIMAL(18,4))), 2) AS DOUBLE)"


def sum_dec(col: str) -> str:
    return f"round(SUM(CAST({col} AS DECIMAL(18,4))), 2)"


def paid_sql(price: str, discount: str) -> str:
    return f"CAST(CAST({price} AS DECIMAL(18,2)) * (1 - CAST({discount} AS DECIMAL(4,2))) AS DOUBLE)"


def ms(expr: str) -> str:
    return f"epoch_ms(CAST({expr} AS TIMESTAMP))"


def to_date_ms(expr: str) -> str:
    return f"CAST(epoch_ms({expr}) AS DATE)"


def s(expr: str) -> str:
    return f"CAST({expr} AS VARCHAR)"


# ---- fixtures: operational tables in landing form (dates as epoch ms) -------------

_PARITY = {"a": "= 0", "b": "= 1"}


def _departments(h: str) -> str:
    where = "" if h == "a" else "WHERE n_nationkey <> 24"
    return f"""SELECT 'DEPT' || {s('n_nationkey')} AS deptid, r_name AS name
    FROM nation JOIN region ON n_regionkey = r_regionkey {where}"""


def _providers(h: str) -> str:
    where = "" if h == "a" else "WHERE s_suppkey % 10 <> 0"
    return f"""SELECT CASE WHEN s_suppkey % 7 = 3 THEN 'X' || {s('s_suppkey')} ELSE 'H-PROV' || {s('s_suppkey')} END AS providerid,
        'DEPT' || {s('s_suppkey % 23')} AS deptid, s_name AS firstname, 'Dr' AS lastname,
        'SPEC' || {s('s_nationkey')} AS specialization, CAST(s_suppkey AS BIGINT) AS npi
    FROM supplier {where}"""


def _patients(h: str) -> str:
    where = "" if h == "a" else "WHERE c_custkey % 10 <> 0"
    pid, first, last, mid = ("patientid", "firstname", "lastname", "middlename") if h == "a" else (
        "id", "f_name", "l_name", "m_name")
    return f"""SELECT 'PT' || {s('c_custkey')} AS {pid}, c_name AS {first},
        CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE c_mktsegment END AS {last},
        CAST(NULL AS VARCHAR) AS {mid},
        lpad({s('c_custkey')}, 9, '0') AS ssn, lpad({s('c_custkey')}, 10, '0') AS phonenumber,
        CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
        CAST(c_custkey % 20000 AS BIGINT) * {DAY_MS} AS dob,
        'ADDR' || {s('c_nationkey')} AS address,
        (CAST(c_custkey % 300 AS BIGINT) + 19723) * {DAY_MS} AS modifieddate
    FROM customer {where}"""


def _encounters(h: str) -> str:
    return f"""SELECT 'ENC' || {s('o_orderkey')} AS encounterid, 'PT' || {s('o_custkey')} AS patientid,
        'DEPT' || {s('o_orderkey % 25')} AS departmentid, 'PROV' || {s('o_orderkey % 10')} AS providerid,
        o_orderpriority AS encountertype, {s('o_orderkey % 1000')} AS procedurecode,
        {ms('o_orderdate')} AS encounterdate, {ms('o_orderdate')} AS inserteddate,
        {ms('o_orderdate')} + {DAY_MS} AS modifieddate
    FROM orders WHERE o_orderkey % 2 {_PARITY[h]}"""


def _transactions(h: str) -> str:
    ship = ms("CAST(l_shipdate AS DATE)")
    return f"""SELECT 'TR' || {s('l_orderkey')} || '-' || {s('l_linenumber')} AS transactionid,
        'ENC' || {s('l_orderkey')} AS encounterid, 'PT' || {s('l_orderkey % 1000')} AS patientid,
        'PROV' || {s('l_suppkey')} AS providerid, 'DEPT' || {s('l_partkey % 25')} AS deptid,
        {ship} AS visitdate, {ship} AS servicedate, {ship} + 30 * CAST({DAY_MS} AS BIGINT) AS paiddate,
        {ship} + {DAY_MS} AS insertdate, {ship} + 2 * CAST({DAY_MS} AS BIGINT) AS modifieddate,
        l_linestatus AS visittype, l_extendedprice AS amount, l_returnflag AS amounttype,
        {paid_sql('l_extendedprice', 'l_discount')} AS paidamount,
        'CL' || {s('l_orderkey')} || '-' || {s('l_linenumber')} AS claimid,
        'PAY' || {s('l_partkey % 5')} AS payorid, {s('l_orderkey % 1000')} AS procedurecode,
        'ICD' || {s('l_partkey % 50')} AS icdcode, 'LOB' || {s('l_partkey % 3')} AS lineofbusiness,
        'MC' || {s('l_partkey')} AS medicaidid, 'ME' || {s('l_partkey')} AS medicareid
    FROM lineitem WHERE l_orderkey % 2 {_PARITY[h]}"""


CLAIM_COLUMNS = f"""'CL' || {s('l_orderkey')} || '-' || {s('l_linenumber')} AS claimid,
        'TR' || {s('l_orderkey')} || '-' || {s('l_linenumber')} AS transactionid,
        'PT' || {s('l_orderkey % 1000')} AS patientid, 'ENC' || {s('l_orderkey')} AS encounterid,
        'PROV' || {s('l_suppkey')} AS providerid, 'DEPT' || {s('l_partkey % 25')} AS deptid,
        CAST(l_shipdate AS DATE) + 45 AS servicedate, CAST(l_shipdate AS DATE) + 50 AS claimdate,
        'PAY' || {s('l_partkey % 5')} AS payorid, l_extendedprice AS claimamount,
        {paid_sql('l_extendedprice', 'l_discount')} AS paidamount,
        CASE l_returnflag WHEN 'A' THEN 'Approved' WHEN 'R' THEN 'Denied' ELSE 'Pending' END AS claimstatus,
        'Ins' AS payortype, l_tax AS deductible, l_discount AS coinsurance, l_quantity AS copay,
        CAST(l_shipdate AS DATE) + 51 AS insertdate, CAST(l_shipdate AS DATE) + 52 AS modifieddate"""

CLAIM_FILE = "CASE WHEN l_orderkey % 2 = 0 THEN 'hospital1_claim_data.csv' ELSE 'hospital2_claim_data.csv' END"

_CLAIMS = f"""SELECT {CLAIM_COLUMNS},
        'landing/claims/' || {CLAIM_FILE} AS source_file_path, {TS} AS extraction_timestamp
    FROM lineitem"""

CPT_CODE = "CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE CAST(p_partkey AS INTEGER) END"
CPT_DESC = "CASE WHEN p_partkey % 10 = 0 THEN p_name || chr(10) || p_type ELSE p_name END"

_CPTCODES = f"""SELECT p_type AS procedure_code_category, {CPT_CODE} AS cpt_codes,
        {CPT_DESC} AS procedure_code_descriptions, p_brand AS code_status, {TS} AS extraction_timestamp
    FROM part"""

FIXTURE_CTES = {}
for _h in ("a", "b"):
    FIXTURE_CTES[f"{_h}_departments"] = _departments(_h)
    FIXTURE_CTES[f"{_h}_providers"] = _providers(_h)
    FIXTURE_CTES[f"{_h}_patients"] = _patients(_h)
    FIXTURE_CTES[f"{_h}_encounters"] = _encounters(_h)
    FIXTURE_CTES[f"{_h}_transactions"] = _transactions(_h)
FIXTURE_CTES["bronze_claims"] = _CLAIMS
FIXTURE_CTES["bronze_cptcodes"] = _CPTCODES

# ---- silver ------------------------------------------------------------------------

_HOSP = {"a": ("HOSP-A-", "hospital-a"), "b": ("HOSP-B-", "hospital-b")}


def _union(fn) -> str:
    return "\n    UNION ALL\n    ".join(fn(h, *_HOSP[h]) for h in ("a", "b"))


SILVER_CTES = {
    "dim_departments": _union(
        lambda h, p, n: f"SELECT '{p}' || deptid AS dept_key, deptid AS dept_id, name AS dept_name, "
        f"'{n}' AS datasource, {TS} AS ingestion_at FROM {h}_departments"
    ),
    "fact_encounters": _union(
        lambda h, p, n: f"""SELECT '{p}' || encounterid AS encounter_key, '{p}' || patientid AS patient_key,
        '{p}' || departmentid AS dept_key, '{p}' || providerid AS provider_key,
        encounterid, encountertype, procedurecode,
        {to_date_ms('encounterdate')} AS encounter_date, {to_date_ms('inserteddate')} AS inserted_date,
        {to_date_ms('modifieddate')} AS modified_date, '{n}' AS datasource, {TS} AS ingestion_at
        FROM {h}_encounters"""
    ),
    "dim_patients": _union(
        lambda h, p, n: (
            f"""SELECT '{p}' || patientid AS patient_key, patientid AS source_patient_id, firstname, lastname,
        middlename, ssn, phonenumber, gender, {to_date_ms('dob')} AS dob, address, '{n}' AS datasource,
        {to_date_ms('modifieddate')} AS valid_from, CAST(NULL AS DATE) AS valid_to, TRUE AS is_current,
        {TS} AS ingestion_at FROM {h}_patients"""
            if h == "a"
            else f"""SELECT '{p}' || id AS patient_key, id AS source_patient_id, f_name AS firstname,
        l_name AS lastname, m_name AS middlename, ssn, phonenumber, gender, {to_date_ms('dob')} AS dob, address,
        '{n}' AS datasource, {to_date_ms('modifieddate')} AS valid_from, CAST(NULL AS DATE) AS valid_to,
        TRUE AS is_current, {TS} AS ingestion_at FROM {h}_patients"""
        )
    ),
    "dim_providers": _union(
        lambda h, p, n: f"""SELECT '{p}' || NULLIF(regexp_extract(providerid, 'PROV.*'), '') AS provider_key,
        '{p}' || deptid AS dept_key, providerid AS source_provider_id, firstname, lastname, specialization, npi,
        '{n}' AS datasource, DATE '{AS_OF[:10]}' AS valid_from, CAST(NULL AS DATE) AS valid_to,
        TRUE AS is_current, {TS} AS ingestion_at FROM {h}_providers"""
    ),
    "fact_transactions": _union(
        lambda h, p, n: f"""SELECT '{p}' || transactionid AS transaction_key, '{p}' || encounterid AS encounter_key,
        '{p}' || patientid AS patient_key, '{p}' || providerid AS provider_key, '{p}' || deptid AS dept_key,
        {to_date_ms('visitdate')} AS visit_date, {to_date_ms('servicedate')} AS service_date,
        {to_date_ms('paiddate')} AS paid_date, {to_date_ms('insertdate')} AS insert_date,
        {to_date_ms('modifieddate')} AS modified_date, visittype, amount, amounttype, paidamount, claimid,
        payorid, procedurecode, icdcode, lineofbusiness, medicaidid, medicareid, '{n}' AS datasource,
        {TS} AS ingestion_at FROM {h}_transactions"""
    ),
    "dim_cptcodes": """SELECT cpt_codes, procedure_code_descriptions, procedure_code_category, code_status,
        extraction_timestamp FROM bronze_cptcodes""",
    "fact_claims": """SELECT claimid,
        (CASE WHEN source_file_path LIKE '%hospital1%' THEN 'HOSP-A-' ELSE 'HOSP-B-' END) || transactionid AS transaction_key,
        (CASE WHEN source_file_path LIKE '%hospital1%' THEN 'HOSP-A-' ELSE 'HOSP-B-' END) || patientid AS patient_key,
        (CASE WHEN source_file_path LIKE '%hospital1%' THEN 'HOSP-A-' ELSE 'HOSP-B-' END) || encounterid AS encounter_key,
        (CASE WHEN source_file_path LIKE '%hospital1%' THEN 'HOSP-A-' ELSE 'HOSP-B-' END) || providerid AS provider_key,
        (CASE WHEN source_file_path LIKE '%hospital1%' THEN 'HOSP-A-' ELSE 'HOSP-B-' END) || deptid AS dept_key,
        servicedate, claimdate, payorid, claimamount, paidamount, claimstatus, payortype, deductible,
        coinsurance, copay, insertdate, modifieddate, source_file_path,
        CASE WHEN source_file_path LIKE '%hospital1%' THEN 'hospital-a' ELSE 'hospital-b' END AS datasource,
        extraction_timestamp AS ingestion_at FROM bronze_claims""",
}

# ---- gold ----------------------------------------------------------------------------

GOLD_SQL = {
    # G1: charge per provider and department name (current providers only)
    "gold_charge_by_provider_dept": f"""
SELECT dp.provider_key, dp.firstname AS provider_first_name, dp.lastname AS provider_last_name,
       dp.specialization, dd.dept_name, dp.datasource,
       {money_sql('ft.amount')} AS total_charge_amount,
       COUNT(ft.transaction_key) AS total_transactions, {TS} AS last_updated_at
FROM fact_transactions ft, dim_providers dp, dim_departments dd
WHERE ft.provider_key = dp.provider_key AND ft.dept_key = dd.dept_key AND dp.is_current
GROUP BY ALL""",
    # Every encounter of a current patient, once per transaction (or once without)
    "gold_patient_history": f"""
SELECT pa.patient_key, pa.source_patient_id, pa.firstname || ' ' || pa.lastname AS patient_full_name,
       pa.gender, pa.dob AS date_of_birth, en.encounter_key, en.encounter_date, en.encountertype AS visit_type,
       pr.firstname || ' ' || pr.lastname AS provider_name, de.dept_name AS department_name,
       tx.icdcode AS diagnosis_code, tx.procedurecode, tx.amount AS charged_amount, tx.paidamount AS amount_paid,
       tx.paid_date, tx.amounttype AS payment_method, pa.datasource, {TS} AS last_updated_at
FROM fact_encounters en
INNER JOIN dim_patients pa ON pa.patient_key = en.patient_key AND pa.is_current
LEFT OUTER JOIN fact_transactions tx ON tx.encounter_key = en.encounter_key
LEFT OUTER JOIN dim_providers pr ON pr.provider_key = en.provider_key
LEFT OUTER JOIN dim_departments de ON de.dept_key = en.dept_key""",
    # Per current provider, encounters / billing / claims, zeros where absent
    "gold_provider_performance": f"""
SELECT dp.provider_key, dp.firstname AS provider_first_name, dp.lastname AS provider_last_name,
       dp.specialization, dp.datasource,
       COALESCE(ve.n_enc, 0) AS total_encounters,
       COALESCE(CAST(vb.billed AS DOUBLE), 0) AS total_billed_amount,
       COALESCE(vc.n_claims, 0) AS total_claims,
       COALESCE(vc.n_approved, 0) AS total_approved_claims,
       COALESCE({ratio_sql('vc.n_approved', 'vc.n_claims', factor=100)}, 0) AS claim_success_rate_percentage,
       {TS} AS last_updated_at
FROM dim_providers dp
LEFT JOIN (SELECT provider_key AS k, COUNT(DISTINCT encounter_key) AS n_enc
           FROM fact_encounters GROUP BY 1) ve ON ve.k = dp.provider_key
LEFT JOIN (SELECT provider_key AS k, {sum_dec('amount')} AS billed
           FROM fact_transactions GROUP BY 1) vb ON vb.k = dp.provider_key
LEFT JOIN (SELECT provider_key AS k, COUNT(claimid) AS n_claims,
                  CAST(SUM(CASE WHEN claimstatus = 'Approved' THEN 1 ELSE 0 END) AS BIGINT) AS n_approved
           FROM fact_claims GROUP BY 1) vc ON vc.k = dp.provider_key
WHERE dp.is_current""",
    # Per department, volume from encounters, money from transactions, staff from providers
    "gold_department_performance": f"""
SELECT dd.dept_key, dd.dept_name, dd.datasource,
       COALESCE(ve.n_pat, 0) AS patient_volume,
       COALESCE(ve.n_enc, 0) AS total_encounters,
       COALESCE(CAST(vm.billed AS DOUBLE), 0) AS total_billed_amount,
       COALESCE(CAST(vm.paid AS DOUBLE), 0) AS total_revenue,
       COALESCE(vs.n_staff, 0) AS provider_count,
       {ratio_sql('ve.n_enc', 'vs.n_staff')} AS avg_encounters_per_provider,
       {ratio_sql('vm.paid * 100', 'vm.billed * 100', factor=100)} AS collection_rate_percentage,
       {TS} AS last_updated_at
FROM dim_departments dd
LEFT JOIN (SELECT dept_key AS k, COUNT(DISTINCT encounter_key) AS n_enc, COUNT(DISTINCT patient_key) AS n_pat
           FROM fact_encounters GROUP BY 1) ve ON ve.k = dd.dept_key
LEFT JOIN (SELECT dept_key AS k, {sum_dec('amount')} AS billed, {sum_dec('paidamount')} AS paid
           FROM fact_transactions GROUP BY 1) vm ON vm.k = dd.dept_key
LEFT JOIN (SELECT dept_key AS k, COUNT(DISTINCT provider_key) AS n_staff
           FROM dim_providers WHERE is_current GROUP BY 1) vs ON vs.k = dd.dept_key""",
    # Monthly billing (visit month) beside monthly claims (service month), newest first
    "gold_financial_metrics": f"""
SELECT COALESCE(mb.src, mc.src) AS datasource,
       COALESCE(mb.mon, mc.mon) AS reporting_month,
       CAST(mb.paid AS DOUBLE) AS total_revenue, CAST(mb.billed AS DOUBLE) AS total_billed_amount,
       mb.n_txn AS transaction_count, CAST(round(mb.billed - mb.paid, 2) AS DOUBLE) AS outstanding_balance,
       mc.n_claims AS total_claims, mc.n_approved AS approved_claims,
       {ratio_sql('mc.n_approved', 'mc.n_claims', factor=100)} AS claim_success_rate_percentage,
       {TS} AS last_updated_at
FROM (SELECT datasource AS src, last_day(visit_date) AS mon, {sum_dec('amount')} AS billed,
             {sum_dec('paidamount')} AS paid, COUNT(DISTINCT transaction_key) AS n_txn
      FROM fact_transactions GROUP BY 1, 2) mb
FULL OUTER JOIN
     (SELECT datasource AS src, last_day(servicedate) AS mon, COUNT(claimid) AS n_claims,
             CAST(SUM(CASE WHEN claimstatus = 'Approved' THEN 1 ELSE 0 END) AS BIGINT) AS n_approved
      FROM fact_claims GROUP BY 1, 2) mc
  ON mb.src = mc.src AND mb.mon = mc.mon
ORDER BY reporting_month DESC, datasource ASC""",
}


def with_ctes(body: str, ctes: dict[str, str]) -> str:
    parts = ",\n".join(f"{name} AS (\n    {sql}\n)" for name, sql in ctes.items())
    return f"WITH {parts}\n{body.strip()}"


def medallion_sql(body: str) -> str:
    """``body`` over fixtures + silver CTEs. A body may start with its own WITH;
    its CTEs are appended after ours."""
    ctes = {**FIXTURE_CTES, **SILVER_CTES}
    text = body.strip()
    if text.upper().startswith("WITH "):
        head = with_ctes("SELECT 1", ctes).rsplit("\nSELECT 1", 1)[0]
        return head + ",\n" + text[5:]
    return with_ctes(text, ctes)


def silver_sql(table: str) -> str:
    return medallion_sql(f"SELECT * FROM {table}")


# ---- sources, sinks and control ------------------------------------------------------

LOAD_DATE = "'30062024'"  # ddMMyyyy of the run date
ENTITIES = ("departments", "encounters", "patients", "providers", "transactions")

_CONFIG = """SELECT db AS database, db || '_db' AS datasource, tbl AS tablename, lt AS loadtype,
        'modifieddate' AS watermark, CASE WHEN s_suppkey % 3 <> 0 THEN '1' ELSE '0' END AS is_active,
        'landing/' || replace(db, '_', '-') || '/' || tbl AS targetpath
    FROM (SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 'hospital_a' ELSE 'hospital_b' END AS db,
                 ['view', 'click', 'signup', 'purchase', 'error', 'encounters'][s_suppkey % 6 + 1] AS tbl,
                 ['full', 'Incremental', 'incremental', 'FULL'][s_suppkey % 4 + 1] AS lt
          FROM supplier)"""

_AUDIT = """SELECT CASE WHEN user_id % 2 = 0 THEN 'hospital_a_db' ELSE 'hospital_b_db' END AS data_source,
        event_type AS tablename, 'incremental' AS load_type, CAST(user_id AS BIGINT) AS record_count,
        CAST(ts AS TIMESTAMP) AS load_timestamp, 'SUCCESS' AS status
    FROM events"""

_CONTROL_CTES = {"load_config": _CONFIG, "audit_log": _AUDIT}


def _events_sql() -> str:
    """Events of the landing runs over ``supplier``'s load specs, in order, a second apart.
    Specs run by source, table and load type; only ``encounters`` can be read."""
    event = lambda n, kind, text, cond: f"SELECT *, {n} AS step, '{kind}' AS event_type, {text} AS message FROM specs WHERE {cond}"
    readable = "tbl = 'encounters'"
    mark = "CASE WHEN lower(lt) = 'full' THEN 'None' ELSE '1900-01-01 00:00:00' END"
    error = "'Error processing ' || tbl || ': KeyError: ' || chr(39) || 'table ' || tbl || ' does not exist in ' || db || chr(39)"
    steps = "\nUNION ALL ".join(
        [
            event(1, "INFO", "'No existing files for table ' || tbl", "TRUE"),
            event(2, "INFO", f"'Latest watermark for ' || tbl || ': ' || {mark}", "TRUE"),
            event(3, "SUCCESS", "'Successfully extracted data from ' || tbl", readable),
            event(4, "SUCCESS", "'JSON files written to ' || name || '/' || tbl", readable),
            event(5, "SUCCESS", "'Audit log updated for ' || tbl", readable),
            event(6, "ERROR", error, f"NOT ({readable})"),
        ]
    )
    return with_ctes(
        """SELECT strftime(TIMESTAMP '2024-06-30 00:00:00' + to_seconds(row_number() OVER (ORDER BY db, n, step) - 1), '%Y-%m-%dT%H:%M:%S') || '+00:00'
                  AS "timestamp", event_type, message, tbl AS "table"
           FROM steps""",
        {
            **_CONTROL_CTES,
            "specs": """SELECT datasource AS db, replace(database, '_', '-') AS name, tablename AS tbl, loadtype AS lt,
                               row_number() OVER (PARTITION BY datasource ORDER BY tablename, loadtype) AS n
                        FROM load_config WHERE is_active = '1'""",
            "steps": steps,
        },
    )


def _count_union(items) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{name}' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM ({src}) AS x"
        for layer, name, src in items
    )


_GOLD_NAMES = {
    "gold_charge_by_provider_dept": "total_charge_amount_per_provider_by_department",
    "gold_patient_history": "patient_history",
    "gold_provider_performance": "provider_performance_summary",
    "gold_department_performance": "department_performance_analytics",
    "gold_financial_metrics": "financial_metrics",
}


def _refresh_counts_sql() -> str:
    items = []
    for h, name in (("a", "hospital-a"), ("b", "hospital-b")):
        for t in ENTITIES:
            items.append(("landing", f"{name}/{t}", f"SELECT * FROM {h}_{t}"))
    items += [("bronze", "claims", "SELECT * FROM bronze_claims"), ("bronze", "cptcodes", "SELECT * FROM bronze_cptcodes")]
    items += [("silver", t, f"SELECT * FROM {t}") for t in SILVER_CTES]
    items += [("gold", _GOLD_NAMES[k], GOLD_SQL[k].strip()) for k in _GOLD_NAMES]
    return medallion_sql(_count_union(items))


SOURCES = (("a", "hospital-a"), ("b", "hospital-b"))


def _both(entity: str) -> str:
    """A table of both hospitals in conformed columns, with load date and source."""
    own = {"patients": "id AS patientid, f_name AS firstname, l_name AS lastname, m_name AS middlename, * EXCLUDE (id, f_name, l_name, m_name)"}
    return "\nUNION ALL BY NAME ".join(
        f"SELECT {own.get(entity, '*') if h == 'b' else '*'}, {LOAD_DATE} AS load_date, '{name}' AS datasource FROM {h}_{entity}" for h, name in SOURCES
    )


def _gold_by_name_sql() -> str:
    picks = (
        ("charge", "gold_charge_by_provider_dept", "provider_key", "dept_name", "total_charge_amount", "CAST(total_transactions AS DOUBLE)"),
        ("history", "gold_patient_history", "patient_key", "encounter_key", "charged_amount", "amount_paid"),
        ("provider", "gold_provider_performance", "provider_key", "specialization", "total_billed_amount", "claim_success_rate_percentage"),
        ("department", "gold_department_performance", "dept_key", "dept_name", "total_billed_amount", "total_revenue"),
        ("finance", "gold_financial_metrics", "datasource", "CAST(reporting_month AS VARCHAR)", "total_revenue", "total_billed_amount"),
    )
    return medallion_sql(
        "\nUNION ALL ".join(
            f"SELECT '{t}' AS tablename, {k1} AS k1, {k2} AS k2, {v1} AS v1, {v2} AS v2 FROM ({GOLD_SQL[q].strip()}) AS {t}"
            for t, q, k1, k2, v1, v2 in picks
        )
    )


def _spend_sql() -> str:
    """The three forms that a table takes in turn."""
    return with_ctes(
        "\nUNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS rewrite, {key} AS k, count(*) AS n, {money_sql('amount')} AS amount FROM facts GROUP BY {key}"
            for i, key in enumerate(("deptid", "payorid", "procedurecode"))
        ),
        {**FIXTURE_CTES, "facts": "SELECT deptid, payorid, procedurecode, amount FROM a_transactions UNION ALL SELECT deptid, payorid, procedurecode, amount FROM b_transactions"},
    )


def _bronze_names_sql() -> str:
    """The last batch of each table after two landing runs: full tables whole, others their delta."""
    keys = {"departments": "deptid", "encounters": "encounterid", "patients": "patientid", "providers": "providerid", "transactions": "transactionid"}
    own = lambda h, t: "id" if (h, t) == ("b", "patients") else keys[t]
    delta = "WHERE modifieddate > epoch_ms(TIMESTAMP '1995-06-30 00:00:00')"
    return "\nUNION ALL ".join(
        f"SELECT 'hospital_{h}_{t}' AS tablename, {own(h, t)} AS source_key, '30092024' AS load_date FROM {h}_{t} {'' if t in ('departments', 'providers') else delta}"
        for h, _ in SOURCES
        for t in ENTITIES
    )


def io_sql() -> dict[str, str]:
    fixtures_only = lambda body: with_ctes(body, FIXTURE_CTES)
    control = lambda body: with_ctes(body, _CONTROL_CTES)
    landing_counts = "\nUNION ALL ".join(
        f"SELECT '{'hospital_a_db' if h == 'a' else 'hospital_b_db'}' AS data_source, '{t}' AS tablename, "
        f"CAST(count(*) AS BIGINT) AS record_count, TIMESTAMP '2024-06-30 00:00:00' AS load_timestamp FROM {h}_{t}"
        for h in ("a", "b")
        for t in ENTITIES
    )
    return {
        "csv_claims_scan": f"SELECT {CLAIM_COLUMNS} FROM lineitem",
        "csv_cptcodes_scan": f"""SELECT p_type AS procedure_code_category, {CPT_CODE} AS cpt_codes,
            {CPT_DESC} AS procedure_code_descriptions, p_brand AS code_status FROM part""",
        "load_config_scan": control("SELECT * FROM load_config"),
        "bronze_json_roundtrip": fixtures_only(_both("patients")),
        **{f"bronze_json_{t}": fixtures_only(_both(t)) for t in ENTITIES},
        "landing_json_roundtrip": fixtures_only(_both("transactions")),
        "bronze_overwrite_idempotent": fixtures_only("SELECT * FROM bronze_claims"),
        "audit_append": control(
            """SELECT data_source, tablename, load_type, CAST(sum(record_count) AS BIGINT) AS record_count,
                   max(load_timestamp) AS load_timestamp, status
            FROM audit_log GROUP BY data_source, tablename, load_type, status, CAST(load_timestamp AS DATE)"""
        ),
        "event_log_append": _events_sql(),
        "event_log_json": _events_sql(),
        "active_load_specs": control(
            "SELECT * FROM load_config WHERE is_active = '1' AND datasource = 'hospital_a_db'"
        ),
        "latest_watermark": control(
            "SELECT data_source, tablename, max(load_timestamp) AS latest_timestamp FROM audit_log GROUP BY 1, 2"
        ),
        "latest_watermark_default": control(
            """SELECT c.datasource, c.tablename, c.loadtype, c.watermark AS watermark_column,
                   COALESCE(m.latest_timestamp, TIMESTAMP '1900-01-01 00:00:00') AS last_watermark
            FROM (SELECT * FROM load_config WHERE is_active = '1') c
            LEFT JOIN (SELECT data_source, tablename, max(load_timestamp) AS latest_timestamp
                       FROM audit_log GROUP BY 1, 2) m
              ON c.datasource = m.data_source AND c.tablename = m.tablename"""
        ),
        "incremental_filter": fixtures_only(
            "\nUNION ALL ".join(
                f"SELECT *, '{name}' AS datasource FROM {h}_transactions WHERE modifieddate > epoch_ms(TIMESTAMP '1998-06-30 00:00:00')"
                for h, name in SOURCES
            )
        ),
        "archive_path_parse": """SELECT 'landing/hospital-a/orders/orders_' || strftime(o_orderdate, '%d%m%Y') || '.json' AS path,
                   strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month, strftime(o_orderdate, '%d') AS day,
                   'orders_' || strftime(o_orderdate, '%d%m%Y') || '.json' AS filename
            FROM orders""",
        "archive_partitioned_roundtrip": fixtures_only(
            "\nUNION ALL ".join(
                f"SELECT *, '2024' AS year, '06' AS month, '30' AS day, '{name}' AS datasource FROM {h}_encounters" for h, name in SOURCES
            )
        ),
        "audit_record_count": fixtures_only(landing_counts),
        "bronze_claims_lineage": f"""SELECT 'CL' || {s('l_orderkey')} || '-' || {s('l_linenumber')} AS claimid,
                   {CLAIM_FILE} AS claim_file,
                   CASE WHEN l_orderkey % 2 = 0 THEN 'hospital-a' ELSE 'hospital-b' END AS datasource,
                   {TS} AS extraction_timestamp
            FROM lineitem""",
        "incremental_second_run": fixtures_only(
            "\nUNION ALL ".join(
                f"""SELECT '{name}' AS datasource, '{t}' AS tablename, {'id' if (h, t) == ('b', 'patients') else key} AS source_key,
                    modifieddate, '{day}' AS load_date FROM {h}_{t} WHERE {cond}"""
                for h, name in SOURCES
                for t, key in (("patients", "patientid"), ("encounters", "encounterid"), ("transactions", "transactionid"))
                for day, cond in (
                    ("30061995", "modifieddate > epoch_ms(TIMESTAMP '1900-01-01 00:00:00')"),
                    ("30092024", "modifieddate > epoch_ms(TIMESTAMP '1995-06-30 00:00:00')"),
                )
            )
        ),
        "silver_from_landing": silver_sql("fact_transactions"),
        "refresh_financial_metrics": medallion_sql(GOLD_SQL["gold_financial_metrics"]),
        "medallion_refresh_counts": _refresh_counts_sql(),
        "refresh_retry": silver_sql("fact_transactions"),
        "refresh_all_batches": medallion_sql(GOLD_SQL["gold_charge_by_provider_dept"]),
        "gold_tables_by_name": _gold_by_name_sql(),
        "names_follow_rewrites": _spend_sql(),
        "snapshot_reads": _spend_sql(),
        "bronze_tables_by_name": fixtures_only(_bronze_names_sql()),
        "audit_marks": control(
            """SELECT data_source, tablename, max(load_timestamp) AS latest_timestamp, count(*) AS loads,
                   CAST(sum(record_count) AS BIGINT) AS record_count FROM audit_log GROUP BY 1, 2"""
        ),
        "refresh_exclusive": fixtures_only(f"SELECT data_source, tablename, CAST(1 AS BIGINT) AS loads, record_count, load_timestamp FROM ({landing_counts}) AS landed"),
    }
