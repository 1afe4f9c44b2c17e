"""The load's steps as queries: checks, events and conformed rows of datasets that come from orders and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from .registry import query

_RAW = """SELECT CAST(o_orderkey AS VARCHAR) AS order_key, CASE WHEN o_orderkey % 9 > 0 THEN CAST(o_custkey AS VARCHAR) END AS castaway_id,
  CASE WHEN o_orderkey % 7 > 0 THEN concat('Y', CAST(year(o_orderdate) AS VARCHAR)) END AS version_season,
  CASE o_orderkey % 4 WHEN 0 THEN ' yes ' WHEN 1 THEN 'False' WHEN 2 THEN 'maybe' END AS paid, CAST(o_custkey % 500 AS VARCHAR) AS place,
    CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_custkey % 31 AS VARCHAR) END AS helper_id FROM orders"""
_PEOPLE = "SELECT CAST(c_custkey AS VARCHAR) AS castaway_id FROM customer WHERE c_custkey % 10 > 0"


def load(t):
    """What landed (names and types), and rows, checks and events of the load."""
    from .. import medallion as L
    from ..sources import normalised_columns

    raw = t.orders.select(
        F.col("o_orderkey").cast("string").alias(" Order Key "), F.when(F.expr("o_orderkey % 9 > 0"), F.col("o_custkey").cast("string")).alias("castaway_id"),
        F.when(F.expr("o_orderkey % 7 > 0"), F.concat(F.lit("Y"), F.year("o_orderdate").cast("string"))).alias("version_season"),
        F.expr("CASE o_orderkey % 4 WHEN 0 THEN ' yes ' WHEN 1 THEN 'False' WHEN 2 THEN 'maybe' END").alias("paid"),
        F.expr("CAST(o_custkey % 500 AS STRING)").alias("place"),
        F.expr("CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_custkey % 31 AS STRING) END").alias("helper_id"), "o_orderpriority",
    )
    people = t.customer.where("c_custkey % 10 > 0").select(F.col("c_custkey").cast("string").alias("castaway_id"))
    person = ("castaway_id",)
    dataset = L.Dataset(
        "journeys", "castaway_id string, version_season string, order_key int, paid boolean, place double, helper_id string",
        ("castaway_id", "version_season"), ("order_key",), ("version_season",),
        repairs=(L.drop_orphans(["order_key"], "castaway_id", "castaway_details", "castaway_id"), L.report_nulls(["order_key"], "version_season")),
        rules=(
            "missing_count(version_season) = 0", "missing_count(castaway_id) = 0", "duplicate_count(order_key) = 0",
            "duplicate_count(place) = 0"
        ),
        context=("order_key",),
        references=(
            L.Reference(person, "castaway_details", person), L.Reference(("helper_id",), "castaway_details", person, True),
            L.Reference(("version_season",), "season_summary", ("version_season",))
        ),
    )
    return normalised_columns(raw).dtypes, L.prepared(raw, dataset, {"castaway_details": people})


_KEPT = f"""raw AS ({_RAW}), people AS ({_PEOPLE}), met AS (SELECT r.*, p.castaway_id IS NULL AS orphan FROM raw r
  LEFT JOIN people p ON p.castaway_id = r.castaway_id),
  ranked AS (SELECT *, CASE WHEN version_season IS NULL THEN 1 ELSE row_number() OVER (PARTITION BY castaway_id,
    version_season ORDER BY order_key) END AS nth FROM met WHERE NOT orphan),
  kept AS (SELECT *, castaway_id || '/' || coalesce(version_season, '') AS key FROM ranked WHERE nth = 1)"""


ROWS_SQL = f"""WITH {_KEPT} SELECT castaway_id, version_season, order_key::INT AS order_key, CASE paid WHEN ' yes ' THEN true
  WHEN 'False' THEN false END AS paid, place::DOUBLE AS place, helper_id FROM kept"""


@query(ROWS_SQL)
def load_rows(t):
    return load(t)[1][0]


CHECKS_SQL = f"""WITH {_KEPT}, missing AS (SELECT key || ' (order_key=' || order_key || ')' AS s FROM kept WHERE version_season IS NULL),
    again AS (SELECT place AS s, count(*) AS n FROM kept GROUP BY place HAVING count(*) > 1), bad AS (SELECT helper_id AS s,
      count(*) AS n FROM kept WHERE helper_id NOT IN (SELECT castaway_id FROM people) GROUP BY 1)
  SELECT 'journeys' AS dataset, 'missing_count(version_season) = 0' AS "check", count(*) AS found, count(*) = 0 AS passed, NULL::BIGINT AS n_null,
    (SELECT string_agg(s, '; ' ORDER BY s) FROM (SELECT s FROM missing ORDER BY s LIMIT 10)) AS samples FROM missing
  UNION ALL SELECT 'journeys', 'missing_count(castaway_id) = 0', 0, true, NULL, NULL
  UNION ALL SELECT 'journeys', 'duplicate_count(order_key) = 0', 0, true, NULL, NULL
  UNION ALL SELECT 'journeys', 'duplicate_count(place) = 0', count(*) - count(DISTINCT place), count(*) = count(DISTINCT place), NULL,
    (SELECT string_agg(s, '; ' ORDER BY s) FROM (SELECT s FROM again ORDER BY s LIMIT 10)) FROM kept
  UNION ALL SELECT 'journeys', 'unique(castaway_id, version_season)', 0, true, NULL, NULL
  UNION ALL SELECT 'journeys', 'castaway_id in castaway_details', 0, true, NULL, NULL
  UNION ALL SELECT 'journeys', 'helper_id in castaway_details', coalesce(sum(n), 0), sum(n) IS NULL, (SELECT count(*) FROM kept
    WHERE helper_id IS NULL), (SELECT string_agg(s, '; ' ORDER BY s) FROM (SELECT s FROM bad ORDER BY s LIMIT 10)) FROM bad
  UNION ALL SELECT 'journeys', 'version_season in season_summary', NULL, true, NULL, NULL"""


@query(CHECKS_SQL)
def load_checks(t):
    return load(t)[1][1]


EVENTS_SQL = f"""WITH {_KEPT}, cast_values AS (SELECT key, order_key, unnest(['paid', 'place']) AS column_name, unnest([paid, place]) AS before,
  unnest([CASE paid WHEN ' yes ' THEN 'true' WHEN 'False' THEN 'false' END, place::DOUBLE::VARCHAR]) AS after FROM kept)
  SELECT 'journeys' AS dataset, 'orphan dropped' AS action, order_key AS row_key, 'castaway_id' AS column_name, castaway_id AS before,
    NULL::VARCHAR AS after, NULL::VARCHAR AS context FROM met WHERE orphan
  UNION ALL SELECT 'journeys', 'null kept', order_key, 'version_season', NULL, NULL, NULL FROM met WHERE NOT orphan AND version_season IS NULL
  UNION ALL SELECT 'journeys', 'duplicate dropped', concat(castaway_id, '/', version_season), NULL, NULL, NULL, NULL FROM ranked WHERE nth > 1
  UNION ALL SELECT 'journeys', 'value coerced', key, column_name, before, after, 'order_key=' || order_key FROM cast_values WHERE before IS DISTINCT FROM after
  UNION ALL SELECT 'journeys', 'column dropped', NULL, 'o_orderpriority', 'string', NULL, NULL"""


@query(EVENTS_SQL)
def load_events(t):
    return load(t)[1][2]
