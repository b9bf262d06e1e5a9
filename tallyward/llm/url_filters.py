"""URL filters as a temporal list join.

``intervals`` turns dated list entries (list, key, action add or remove, day) into
validity intervals [valid_from, valid_to). ``judge`` evaluates every capture against the
entries active on the day of its fetch: a capture looks up its host, the host's parent
domains and its host with the first path segment. Intervals of a key are one row with an
array in order of time, so the join is by key alone, gives one row for each key of a
capture, and the as-of condition is evaluated inside the row: a host with a
third of all captures makes no more rows, and its side of the join may be split.

A capture is blocked if an active entry of a blocking list names one of its keys and no
active entry of the allow list names a key at least as specific.

Rows: a null url, or one without a host, has no keys and is allowed; a null day
meets no entry; repeated captures are judged each; entries with a null are not used,
repeated ones count once, and of an addition and a removal on one day the addition holds;
empty tables give no rows (captures) or allow all (entries); other columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyward.llm.common import written

ALLOW = "allow"

# The parts of a URL (dialects of Spark and DuckDB agree on these).
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)"


def host_of(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, HOST, 1)), F.lit(""))


def keys_of(url: Column) -> Column:
    """The keys of a URL from the least specific (a domain of two labels) to host/segment."""
    host, segment = host_of(url), F.regexp_extract(url, SEGMENT, 1)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.when(n < 2, F.array(host)).otherwise(
        F.transform(F.sequence(F.lit(2), F.greatest(n, F.lit(2))), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    )
    own = F.when(segment != "", F.array(F.concat(host, F.lit("/"), segment))).otherwise(F.slice(F.array(host), 1, 0))
    return F.when(host.isNotNull(), F.concat(suffixes, own))


def intervals(entries: DataFrame) -> DataFrame:
    """(list, key, valid_from, valid_to) of dated entries (list, key, action, day)."""
    known = entries.where("list is not null and key is not null and day is not null and action in ('add', 'remove')")
    # one state for each day: a window then holds at most as many rows as there are days
    daily = known.groupBy("list", "key", "day").agg(F.max((F.col("action") == "add").cast("int")).alias("active"))
    order = Window.partitionBy("list", "key").orderBy("day")
    changes = daily.withColumn("before", F.lag("active", 1, 0).over(order)).where("active <> before")
    spans = changes.withColumn("valid_to", F.lead("day").over(order)).where("active = 1")
    return spans.select("list", "key", F.col("day").alias("valid_from"), "valid_to")


def judge(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """(page_id, host, captured_on, verdict, n_active, lists, rule, active_since) of every
    capture (page_id, url, captured_on)."""
    spans = F.sort_array(F.collect_list(F.struct("valid_from", "valid_to", "list")))
    by_key = intervals(entries).groupBy("key").agg(spans.alias("spans"))
    rows = captures.select("page_id", "url", "captured_on", host_of(F.col("url")).alias("host"))
    rows = written(rows.withColumn("_row", F.monotonically_increasing_id()), "captures")  # a row's number stays once written
    looked = rows.select("_row", "captured_on", F.posexplode(keys_of(F.col("url"))).alias("level", "key")).join(by_key, "key")
    day = F.col("captured_on")
    active = F.filter("spans", lambda s: (s.valid_from <= day) & (s.valid_to.isNull() | (s.valid_to > day)))
    hits = looked.select("_row", "level", "key", F.explode(active).alias("s"))
    best = F.max(F.struct("level", "key", F.date_diff(F.lit("9999-12-31").cast("date"), F.col("s.valid_from")).alias("age"), F.col("s.valid_from").alias("since")))
    found = hits.groupBy("_row").agg(
        F.count("*").alias("n_active"),
        F.array_join(F.sort_array(F.collect_set("s.list")), ",").alias("lists"),
        F.max(F.when(F.col("s.list") == ALLOW, F.col("level"))).alias("allowed"),
        F.max(F.when(F.col("s.list") != ALLOW, F.col("level"))).alias("blocked"),
        best.alias("best"),
    )
    blocks = F.col("blocked").isNotNull() & (F.col("allowed").isNull() | (F.col("allowed") < F.col("blocked")))
    return rows.join(found, "_row", "left").select(
        "page_id",
        "host",
        "captured_on",
        F.when(blocks, "block").otherwise("allow").alias("verdict"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"),
        F.coalesce("lists", F.lit("")).alias("lists"),
        F.col("best.key").alias("rule"),
        F.col("best.since").alias("active_since"),
    )


# --- entries and captures of the test tables ----------------------------------
# `pages` has neither fetch days nor lists; both are derived from its rows, by digests
# that DuckDB gives as well, so that they grow with the table.

LISTS = ("adult", "malware", "spam", ALLOW)
FIRST_DAY = "2024-01-01"


def _number(text: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(text), 4 * at + 1, 4), 16, 10).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    day = F.date_add(F.lit(FIRST_DAY).cast("date"), _number(F.col("page_id").cast("string"), 0) % 730)
    return pages.select("page_id", "url", day.alias("captured_on"))


def entries_of(pages: DataFrame) -> DataFrame:
    """Of every key in the pages, about one in three is on a list; entries come, go and come back."""
    keys = pages.select(F.explode(keys_of(F.col("url"))).alias("key")).distinct()
    each = keys.select("key", F.explode(F.array(*[F.lit(x) for x in LISTS])).alias("list"))
    text = F.concat_ws("|", "list", "key")
    each = each.where(_number(text, 0) % 12 == 0)
    start = F.date_add(F.lit(FIRST_DAY).cast("date"), _number(text, 1) % 500)
    stop = F.date_add(start, _number(text, 2) % 200)
    again = F.date_add(stop, _number(text, 3) % 90)
    dated = lambda action, day: F.struct(F.lit(action).alias("action"), day.alias("day"))
    events = F.array(dated("add", start), dated("add", F.date_add(start, 3)), dated("remove", stop), dated("add", again))
    events = F.when(_number(text, 4) % 2 == 0, F.slice(events, 1, 3)).otherwise(events)
    return each.select("list", "key", F.explode(events).alias("e")).select("list", "key", "e.action", "e.day")


_NUMBER = "('0x' || substr(md5({}), {}, 4))::INT"


def _sql_number(text: str, at: int) -> str:
    return _NUMBER.format(text, 4 * at + 1)


ORACLE_SQL = f"""
WITH parts AS (
  SELECT row_number() OVER () AS rid, page_id, url,
         nullif(lower(regexp_extract(url, '{HOST}', 1)), '') AS host,
         regexp_extract(url, '{SEGMENT}', 1) AS segment,
         DATE '{FIRST_DAY}' + {_sql_number("CAST(page_id AS VARCHAR)", 0)} % 730 AS captured_on
  FROM pages),
labels AS (SELECT *, string_split(host, '.') AS l, len(string_split(host, '.')) AS n FROM parts WHERE host IS NOT NULL),
keys AS (
  SELECT rid, captured_on, k - 2 AS level, array_to_string(l[n - k + 1:n], '.') AS key
  FROM (SELECT *, unnest(range(2, n + 1)) AS k FROM labels WHERE n >= 2)
  UNION ALL SELECT rid, captured_on, 0, host FROM labels WHERE n < 2
  UNION ALL SELECT rid, captured_on, greatest(n - 1, 1), host || '/' || segment FROM labels WHERE segment <> ''),
listed AS (
  SELECT list, key, list || '|' || key AS t
  FROM (SELECT DISTINCT key FROM keys), (SELECT unnest(['{"', '".join(LISTS)}']) AS list)),
dated AS (
  SELECT *, DATE '{FIRST_DAY}' + {_sql_number("t", 1)} % 500 AS d0
  FROM listed WHERE {_sql_number("t", 0)} % 12 = 0),
stops AS (SELECT *, d0 + {_sql_number("t", 2)} % 200 AS d1 FROM dated),
events AS (
  SELECT list, key, 1 AS active, d0 AS day FROM stops
  UNION ALL SELECT list, key, 1, d0 + 3 FROM stops
  UNION ALL SELECT list, key, 0, d1 FROM stops
  UNION ALL SELECT list, key, 1, d1 + {_sql_number("t", 3)} % 90 FROM stops WHERE {_sql_number("t", 4)} % 2 = 1),
daily AS (SELECT list, key, day, max(active) AS active FROM events GROUP BY ALL),
changes AS (SELECT * FROM (SELECT *, lag(active, 1, 0) OVER (PARTITION BY list, key ORDER BY day) AS before FROM daily) WHERE active <> before),
spans AS (SELECT * FROM (SELECT *, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS valid_to FROM changes) WHERE active = 1),
hits AS (
  SELECT k.rid, k.level, k.key, s.list, s.day AS since
  FROM keys k JOIN spans s ON s.key = k.key AND s.day <= k.captured_on AND (s.valid_to IS NULL OR s.valid_to > k.captured_on)),
best AS (SELECT rid, key, since FROM hits QUALIFY row_number() OVER (PARTITION BY rid ORDER BY level DESC, since) = 1),
found AS (
  SELECT rid, count(*) AS n_active, array_to_string(list_sort(list(DISTINCT list)), ',') AS lists,
         max(level) FILTER (list = '{ALLOW}') AS allowed, max(level) FILTER (list <> '{ALLOW}') AS blocked
  FROM hits GROUP BY rid)
SELECT page_id, host, captured_on,
       CASE WHEN blocked IS NOT NULL AND (allowed IS NULL OR allowed < blocked) THEN 'block' ELSE 'allow' END AS verdict,
       coalesce(n_active, 0) AS n_active, coalesce(lists, '') AS lists, best.key AS rule, best.since AS active_since
FROM parts LEFT JOIN found USING (rid) LEFT JOIN best USING (rid)
"""
