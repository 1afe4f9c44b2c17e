"""Data-quality reports and change detection."""

from functools import reduce

from pyspark.sql import functions as F

from .. import operators as O
from .. import snapshots as S
from ..staging import fresh_path
from .game import sql_over
from .loads import CHECKS_SQL, EVENTS_SQL, ROWS_SQL, load
from .models import build_models
from .registry import query

_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"]


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) FILTER (WHERE v IS NULL) AS n_null, count(*) - count(DISTINCT v) - coalesce(max((v IS NULL)::INT), 0) AS n_duplicate FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN {c} END AS v FROM orders)" for c in _COLUMNS
    )
)
def null_dup_summary(t):
    known = F.col("o_orderstatus") != "P"
    return O.profile(t.orders.select(*(F.when(known, F.col(c)).alias(c) for c in _COLUMNS)))


@query(
    """SELECT user_id, k, n_rows, CASE WHEN k IS NULL THEN 'null in key' ELSE 'duplicate' END AS problem FROM (SELECT user_id, nullif(event_type,
      'error') AS k, count(*) AS n_rows FROM events GROUP BY 1, 2) WHERE n_rows > 1 OR k IS NULL"""
)
def unique_check(t):
    return O.duplicates_of_key(t.events.select("user_id", F.nullif(F.col("event_type"), F.lit("error")).alias("k")), ["user_id", "k"])


@query("""WITH o AS (SELECT DISTINCT year(o_orderdate)::VARCHAR || '-' || month(o_orderdate)::VARCHAR AS v FROM orders),
  s AS (SELECT DISTINCT year(l_shipdate)::VARCHAR || '-' || month(l_shipdate)::VARCHAR AS v FROM lineitem)
SELECT coalesce(o.v, s.v) AS value, CASE WHEN s.v IS NULL THEN 'missing' ELSE 'unexpected' END AS status FROM o FULL JOIN s ON o.v = s.v
  WHERE o.v IS NULL OR s.v IS NULL""")
def coverage(t):
    month = lambda c: F.concat_ws("-", F.year(c).cast("string"), F.month(c).cast("string")).alias("month")
    return O.coverage(t.lineitem.select(month("l_shipdate")), t.orders.select(month("o_orderdate")), "month")


@query("""WITH a AS (SELECT c_nationkey AS k, count(*) AS n, min(c_name) AS s FROM customer WHERE c_nationkey <> 3 GROUP BY 1),
  b AS (SELECT c_nationkey AS k, count(*) + CASE WHEN c_nationkey % 4 = 0 THEN 1 ELSE 0 END AS n,
  CASE WHEN c_nationkey % 5 <> 0 THEN min(c_name) END AS s FROM customer WHERE c_nationkey <> 7 GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, CASE WHEN b.k IS NULL THEN 'new' WHEN a.k IS NULL THEN 'gone' WHEN a.n IS DISTINCT FROM b.n
  OR a.s IS DISTINCT FROM b.s THEN 'changed' ELSE 'unchanged' END AS status FROM a FULL JOIN b ON a.k = b.k""")
def change_detection(t):
    per = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.count(F.lit(1)).alias("n"), F.min("c_name").alias("s"))
    stored = per.where("k <> 7").select(
        "k", (F.col("n") + F.when(F.col("k") % 4 == 0, 1).otherwise(0)).alias("n"), F.when(F.col("k") % 5 != 0, F.col("s")).alias("s")
    )
    return O.source_changes(per.where("k <> 3"), stored, "k", ["n", "s"])


@query("""SELECT c_custkey, 'c_mktsegment' AS column_name, c_mktsegment AS before, nullif(lower(trim(c_mktsegment)), 'building') AS after,
  lower(trim(c_mktsegment)) = 'building' AS became_null FROM customer
WHERE c_mktsegment IS DISTINCT FROM nullif(lower(trim(c_mktsegment)), 'building')""")
def value_changes(t):
    before = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    after = before.withColumn("c_mktsegment", F.nullif(F.lower(F.trim("c_mktsegment")), F.lit("building")))
    return O.value_changes(before, after, "c_custkey", ["c_name", "c_mktsegment"])


_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in _TABLES))
def table_counts(t):
    return reduce(
        lambda a, b: a.unionByName(b),
        (getattr(t, n).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows") for n in _TABLES)
    )


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}::DOUBLE, {b}::DOUBLE), 6) AS correlation FROM lineitem" for a in _NUMBERS for b in _NUMBERS
    )
)
def correlation_matrix(t):
    return O.correlation_matrix(t.lineitem, _NUMBERS).withColumn("correlation", F.round("correlation", 6))


@query("""WITH l AS (SELECT DISTINCT 'd' || s_nationkey AS dataset FROM supplier WHERE s_nationkey % 2 = 0),
  c AS (SELECT 'd' || n_nationkey AS dataset FROM nation WHERE n_nationkey % 3 > 0), u AS (SELECT 'd' || (n_nationkey + 3) AS dataset FROM nation
  WHERE n_nationkey % 5 > 0),
  a AS (SELECT dataset FROM l UNION SELECT dataset FROM c UNION SELECT dataset FROM u), f AS (SELECT dataset, dataset IN (FROM l) AS is_loaded,
    dataset IN (FROM c) AS is_configured, dataset IN (FROM u) AS is_upstream FROM a)
  SELECT *, CASE WHEN is_loaded THEN CASE WHEN is_upstream THEN 'Loaded' ELSE 'Loaded (not found upstream)' END
    WHEN is_configured THEN 'Configured but not loaded' ELSE 'Not configured' END AS status FROM f""")
def dataset_coverage(t):
    name = lambda e: F.concat(F.lit("d"), e.cast("string")).alias("dataset")
    key = F.col("n_nationkey")
    return O.dataset_coverage(
        t.supplier.where("s_nationkey % 2 = 0").select(name(F.col("s_nationkey"))), t.nation.where("n_nationkey % 3 > 0").select(name(key)),
        t.nation.where("n_nationkey % 5 > 0").select(name(key + 3))
    )


_REPORT_SQL = f"""WITH checks AS ({CHECKS_SQL}), events AS ({EVENTS_SQL}), kept AS ({ROWS_SQL}),
  cells AS (SELECT unnest(['castaway_id', 'version_season', 'order_key', 'paid', 'place', 'helper_id']) AS c, unnest([castaway_id, version_season,
    order_key::VARCHAR, paid::VARCHAR, place::VARCHAR, helper_id]) AS v FROM kept),
  kinds AS (SELECT *, CASE WHEN "check" LIKE 'unique(%' THEN 'Unique Constraint' WHEN "check" LIKE '%_count(%' THEN 'Rule Checks'
    ELSE 'Foreign Key Checks' END AS section FROM checks),
  acts AS (SELECT action, count(*) AS n, coalesce(string_agg(DISTINCT column_name, ', ' ORDER BY column_name), '') AS columns FROM events GROUP BY 1),
  years AS (SELECT DISTINCT 'Y' || year(l_shipdate) AS y FROM lineitem), seen AS (SELECT DISTINCT version_season AS y FROM kept
    WHERE version_season IS NOT NULL),
  types(c, landed, stored) AS (VALUES ('castaway_id', 'string', 'string'), ('version_season', 'string', 'string'), ('order_key', 'string', 'int'),
    ('paid', 'string', 'boolean'), ('place', 'string', 'double'), ('helper_id', 'string', 'string'), ('o_orderpriority', 'string', NULL)),
  everything AS (
    SELECT 'Summary' AS section, 'journeys' AS item, unnest(['status', 'checks_run', 'checks_failed', 'row_count']) AS metric,
      unnest([CASE WHEN bool_and(passed) THEN 'passed' ELSE 'failed' END, count(*)::VARCHAR, (count(*) FILTER (WHERE NOT passed))::VARCHAR,
      (SELECT count(*) FROM kept)::VARCHAR]) AS value FROM checks
    UNION ALL SELECT 'Column Types', c, unnest(['landed_type', 'stored_type']), unnest([landed, stored]) FROM types
    UNION ALL SELECT section, "check", unnest(['found', 'status', 'n_null']), unnest([found::VARCHAR,
      CASE WHEN found IS NULL THEN 'skipped' WHEN passed THEN 'passed' ELSE 'failed' END, n_null::VARCHAR]) FROM kinds
    UNION ALL SELECT 'Samples', "check", 'samples', samples FROM checks
    UNION ALL SELECT 'Null Value Summary', c, 'null_count', count(*)::VARCHAR FROM cells WHERE v IS NULL GROUP BY c
    UNION ALL SELECT 'Distinct Values', c, 'n_distinct', count(DISTINCT v)::VARCHAR FROM cells GROUP BY c
    UNION ALL SELECT 'Remediation Events', action, 'events', string_agg(n, ', ' ORDER BY n) FROM (SELECT action,
      count(*)::VARCHAR AS n FROM events GROUP BY action, column_name) GROUP BY 2
    UNION ALL SELECT 'Remediation Events', action, 'column', string_agg(column_name, ', ' ORDER BY column_name) FROM (SELECT DISTINCT action,
      column_name FROM events) GROUP BY 2
    UNION ALL SELECT 'Issues', action, 'impact', CASE action WHEN 'orphan dropped' THEN 'Removed ' || n || ' rows without a parent'
      WHEN 'duplicate dropped' THEN 'Removed ' || n || ' rows of a key that another row has' WHEN 'null kept' THEN 'Affected ' || n || ' rows with a null'
      WHEN 'value coerced' THEN 'Column coerced in ' || n || ' rows' ELSE 'Dropped ' || n || ' columns' END || CASE WHEN columns <> '' THEN '; columns: ' || columns ELSE '' END FROM acts
    UNION ALL SELECT 'Unexpected Columns', 'o_orderpriority', 'landed_type', 'string'
    UNION ALL SELECT 'Season Coverage', 'version_season', unnest(['present_count', 'missing_count', 'unexpected_count', 'missing', 'unexpected']),
      unnest([(SELECT count(*) FROM seen)::VARCHAR, (SELECT count(*) FROM years WHERE y NOT IN (FROM seen))::VARCHAR,
      (SELECT count(*) FROM seen WHERE y NOT IN (FROM years))::VARCHAR,
      (SELECT string_agg(y, ', ' ORDER BY y) FROM years WHERE y NOT IN (FROM seen)), (SELECT string_agg(y,
        ', ' ORDER BY y) FROM seen WHERE y NOT IN (FROM years))])
  ) SELECT 'journeys' AS dataset, section, item, metric, value FROM everything WHERE value IS NOT NULL"""


@query(_REPORT_SQL)
def quality_report(t):
    """The sections of the report of a load."""
    landed, (rows, checks, events) = load(t)
    years = t.lineitem.select(F.concat(F.lit("Y"), F.year("l_shipdate").cast("string")).alias("version_season"))
    return O.dataset_report("journeys", rows, landed, checks, events, season="version_season", baseline=years)


#: Columns of the models that no row may have null, and those that must be unique (fixed values).
NOT_NULL = {
    **{
        m: (f"{m}_key",) for m in (
            "advantage_strategy", "challenge_performance", "edit_features", "jury_analysis", "season_context", "social_positioning",
            "vote_dynamics"
        )
    },
    "castaway_profile": ("castaway_id",), "ml_features_non_edit": ("castaway_id", "version_season"), "ml_features_hybrid": ("castaway_id", "version_season"),
}
UNIQUE = {"season_context": ("season_context_key",)}


@query(sql_over(" UNION ALL ".join(
    [
        f"SELECT '{m}' AS model, '{c}' AS column_name, 'not_null' AS test, count(*) FILTER (WHERE {c} IS NULL) AS failures FROM {m}" for m,
        cs in NOT_NULL.items() for c in cs
    ]
    + [f"SELECT '{m}', '{c}', 'unique', count(*) FROM (SELECT {c} FROM {m} WHERE {c} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)" for m, cs in UNIQUE.items() for c in cs])))
def model_tests(t):
    """The tests of all models: one aggregate a model over the columns that it tests."""
    from .game import bronze

    models, parts = build_models(bronze(t)), []
    for m, columns in NOT_NULL.items():
        counts = [F.struct(F.lit(c).alias("column_name"), F.lit("not_null").alias("test"), F.count_if(F.col(c).isNull()).alias("failures")) for c in columns]
        parts.append(models[m].agg(F.array(*counts).alias("all")).select(F.lit(m).alias("model"), F.inline("all")))
    for m, columns in UNIQUE.items():
        for c in columns:
            again = models[m].dropna(subset=[c]).groupBy(c).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
            parts.append(
                again.agg(F.count(F.lit(1)).alias("failures")).select(
                    F.lit(m).alias("model"), F.lit(c).alias("column_name"), F.lit("unique").alias("test"), "failures"
                )
            )
    return reduce(lambda a, b: a.unionByName(b), parts)


_RUN = "SELECT md5(coalesce(run, '') || '|' || coalesce(environment, '')) AS snapshot_id, run AS ingest_run_id, environment, 'feature snapshot' AS notes FROM ({0})"


@query(f"""{_RUN.format("SELECT o_orderkey::VARCHAR AS run, o_orderpriority AS environment FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1")}
  UNION ALL {_RUN.format("SELECT NULL::VARCHAR AS run, 'dev' AS environment")}""")
def snapshot_rows(t):
    """The snapshot of the latest run, and what stands in where there is none."""
    runs = t.orders.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("environment"), F.col("o_orderdate").alias("run_started_at"))
    return S.snapshot_row(runs, environment="dev").unionByName(S.snapshot_row(runs.where("false"), environment="dev"))


@query(
    """SELECT c_custkey, c_acctbal, 'first' AS snapshot_id, 'before' AS read FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT c_custkey,
      c_acctbal + 1, 'second', 'latest' FROM customer WHERE c_custkey % 3 = 0"""
)
def snapshots_side_by_side(t):
    """Two loads of a table, the second run twice, read as of a time between them and as of now."""
    path, rows = fresh_path(t.spark, "features"), t.customer.select("c_custkey", "c_acctbal")
    second = rows.where("c_custkey % 3 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    for df, id in ((rows.where("c_custkey % 2 = 0"), "first"), (second, "second"), (second, "second")):
        S.write_snapshot(df, path, id)
    taken = t.spark.createDataFrame(
        [("first", "2024-01-01 00:00:00"), ("second", "2024-01-03 00:00:00")], "snapshot_id string, at string"
    ).select("snapshot_id", F.to_timestamp("at").alias("taken_at"))
    before = S.read_snapshot(t.spark, path, taken, at="2024-01-02 00:00:00").withColumn("read", F.lit("before"))
    return before.unionByName(S.read_snapshot(t.spark, path, taken).withColumn("read", F.lit("latest")))


@query("""WITH e AS (SELECT sha1(event_type || '|' || (user_id % 100)) AS event_key, event_type, user_id % 100 AS who, day(ts) AS d FROM events),
  a AS (SELECT event_key, min(event_type) AS event_type, min(who) AS who FROM e WHERE d <= 10 GROUP BY 1)
  SELECT *, 'first' AS run FROM a UNION ALL SELECT event_key, min(event_type), min(who), 'second' FROM e WHERE d > 5
    AND event_key NOT IN (SELECT event_key FROM a) GROUP BY 1""")
def events_told_once(t):
    """Events of two runs, of which the second overlaps the first and is repeated: each key is told by the first run that has it."""
    rows = t.events.select("event_type", (F.col("user_id") % 100).alias("who"), F.day("ts").alias("d"))
    rows = rows.withColumn("event_key", S.event_key(F.col("event_type"), F.col("who"))).select("event_key", "event_type", "who", "d")
    path = fresh_path(t.spark, "seen")
    first = S.record_events(rows.where("d <= 10").drop("d"), path, "first").withColumn("run", F.lit("first"))
    for _ in range(2):
        second = S.record_events(rows.where("d > 5").drop("d"), path, "second")
    return first.unionByName(second.withColumn("run", F.lit("second")))
