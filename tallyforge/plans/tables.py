"""Landed files, layered tables, rule catalogues and cell functions as queries."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import functions as T
from .. import operators as O
from ..rules import RULES
from ..sources import Warehouse, close_run, latest_run, load_freshest, normalised_columns, open_run, with_lineage
from ..staging import fresh_path
from .game import bronze, sql_over
from .registry import query
from .star import sources, star_sql


@query("""SELECT c_custkey, c_name, 'csv' AS format FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT s_suppkey, s_name, 'json' FROM supplier""")
def landed_extracts(t):
    """Of several extracts of a dataset the freshest, of equals the preferred format, read as what it is."""
    path, schema = fresh_path(t.spark, "landed"), StructType.fromDDL("id long, name string")
    people, makers = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    ), t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    people.where("id % 2 = 0").write.option("header", True).csv(f"{path}/people_new")
    people.write.json(f"{path}/people_old")
    makers.write.json(f"{path}/makers")
    makers.where("false").write.option("header", True).csv(f"{path}/makers_csv")
    listed = [("people", "csv", "people_new", 2), ("people", "jsonl", "people_old", 1), ("makers", "jsonl", "makers", 5), ("makers", "csv", "makers_csv", 5)]
    manifest = t.spark.createDataFrame([(d, f, f"{path}/{p}", at) for d, f, p, at in listed], "dataset string, format string, path string, committed_at int")
    both = [load_freshest(t.spark, manifest, d, schema, prefer="jsonl").withColumn("format", F.lit(f)) for d, f in (("people", "csv"), ("makers", "json"))]
    return both[0].unionByName(both[1]).select(F.col("id").alias("c_custkey"), F.col("name").alias("c_name"), "format")


@query("""SELECT 'nations' AS what, n_name AS name, n_regionkey::VARCHAR AS value FROM nation WHERE n_nationkey % 4 > 0 UNION ALL
  SELECT 'nations', 'new ' || n_name, '9' FROM nation WHERE n_nationkey % 4 = 0
  UNION ALL SELECT 'log', n_name, n_nationkey::VARCHAR FROM nation WHERE n_nationkey < 3 UNION ALL SELECT 'log', n_name,
    n_nationkey::VARCHAR FROM nation WHERE n_nationkey < 3
  UNION ALL SELECT 'by region', r_name, count(*)::VARCHAR FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey % 4 > 0 GROUP BY r_name
  UNION ALL SELECT unnest(['tables', 'tables', 'tables', 'tables', 'columns', 'columns', 'columns', 'run', 'exported', 'exported']),
    unnest(['bronze.ingestion_runs', 'bronze.log', 'bronze.nations', 'silver.by_region', 'key', 'name', 'region', 'succeeded', 'bronze', 'silver']),
    unnest([NULL, NULL, NULL, NULL, 'bigint', 'string', 'bigint', 'test', '3', '1'])""")
def warehouse_tables(t):
    """Tables written in each mode and layer, found by name, described, queried in SQL, exported; and the latest run."""
    mark = uuid.uuid4().hex[:12]
    layers = {x: f"{x}_{mark}" for x in ("bronze", "silver")}
    w = Warehouse(t.spark, tuple(layers.values()), fresh_path(t.spark, "warehouse"))
    nations = t.nation.select(F.col("n_nationkey").cast("long").alias("key"), F.col("n_name").alias("name"), F.col("n_regionkey").cast("long").alias("region"))
    bronze_layer, silver_layer = layers.values()
    w.write(nations.where("key < 3").select("key", "name", "region"), bronze_layer, "nations")
    w.write(nations, bronze_layer, "nations")
    news = nations.where("key % 4 = 0").select("key", F.concat(F.lit("new "), "name").alias("name"), F.lit(9).cast("long").alias("region"))
    w.write(news, bronze_layer, "nations", "upsert", ["key"])
    for _ in range(2):
        w.write(nations.where("key < 3"), bronze_layer, "log", "upsert")
    t.region.select(F.col("r_regionkey").cast("long").alias("region"), F.col("r_name").alias("r_name")).createOrReplaceTempView(f"region_{mark}")
    counted = w.sql(f"SELECT r_name, count(*) AS n FROM {bronze_layer}.nations JOIN region_{mark} USING (region) GROUP BY r_name")
    w.write(counted, silver_layer, "by_region")
    open_run_id = _run(w, bronze_layer)
    row = lambda df, what, name, value: df.select(F.lit(what).alias("what"), name.cast("string").alias("name"), value.cast("string").alias("value"))
    names = {v: k for k, v in layers.items()}
    listed = t.spark.createDataFrame([(f"{names[x]}.{n}",) for x, n in w.list_tables()], "name string")
    manifest = w.export(silver_layer, fresh_path(t.spark, "export"))
    none = F.lit(None)
    return reduce(DataFrame.unionByName, [
        row(w.load("nations"), "nations", F.col("name"), F.col("region")), row(w.load("log"), "log", F.col("name"), F.col("key")),
        row(w.load(f"{silver_layer}.by_region"), "by region", F.col("r_name"), F.col("n")),
        row(listed, "tables", F.col("name"), none), row(w.describe("nations"), "columns", F.col("col_name"), F.col("data_type")),
        row(w.load("ingestion_runs").where(F.col("run_id") == open_run_id), "run", F.col("status"), F.col("environment")),
        row(manifest.groupBy("layer").agg(F.count(F.lit(1)).alias("n")), "exported", F.substring_index("layer", "_", 1), F.col("n")),
    ])


def _run(w: Warehouse, layer: str) -> str:
    run = open_run(w, "test", "2024-01-01 00:00:00", layer=layer)
    close_run(w, run, "succeeded", "2024-01-01 01:00:00", layer=layer)
    return latest_run(w, layer).first().run_id


@query(
    """SELECT o_orderkey, o_orderstatus AS rank_order, 'r1' AS ingest_run_id, CASE WHEN o_orderkey % 3 = 0 THEN 'orders'
      ELSE o_orderpriority END AS source_dataset FROM orders"""
)
def lineage_columns(t):
    """Names in one style, a reserved one renamed, and lineage, which leaves a source that is known."""
    landed = t.orders.select(
        F.col("o_orderkey").alias(" O OrderKey "), F.col("o_orderstatus").alias("Order"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderpriority")).alias("Source_Dataset")
    )
    named = normalised_columns(landed, {"order": "rank_order", "o_orderkey": "o_orderkey"})
    return with_lineage(named, "r1", "orders", "2024-01-01 00:00:00").drop("ingested_at")


_CHECKED = ("castaway_details", "season_summary", "episodes", "advantage_details", "challenge_description", "advantage_movement", "tribe_mapping")


def _rule_sql(name: str) -> str:
    count = {"missing": "count(*) FILTER (WHERE {c} IS NULL)", "duplicate": "count(*) - count(DISTINCT {c}) - coalesce(max(({c} IS NULL)::INT), 0)"}
    rules = [(r, *O.rule_parts(r)) for r in RULES[name]]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS dataset, '{r}' AS rule, {count[k].format(c=c)} AS found, {count[k].format(c=c)} = {n} AS passed FROM {name}" for r,
        k, c, n in rules
    )


@query(f"WITH {star_sql('fact_advantage_movement', 'fact_tribe_membership')} " + " UNION ALL ".join(map(_rule_sql, _CHECKED)))
def rule_catalogue(t):
    """The catalogue's rules for the datasets that can be derived here, one pass a dataset."""
    found = sources(t, *_CHECKED)
    return reduce(DataFrame.unionByName, (O.run_rules(df, RULES[n]).select(F.lit(n).alias("dataset"), "rule", "found", "passed") for n, df in found.items()))


@query("""WITH p AS (SELECT p_partkey, string_split(p_name, ' ') AS ids, string_split(p_type, ' ') AS names FROM part), u AS (SELECT p_partkey,
  ids, names, unnest(ids) AS id, generate_subscripts(ids, 1) AS i FROM p)
  SELECT p_partkey, id, names[least(i, len(names))] AS name, len(ids) > 1 AS joint, t AS target,
    nullif(array_to_string(list_distinct_in_order(list_concat(list_filter(ids, lambda x: x <> id), list_filter(['a', 'b'], lambda x: x <> t))), ', '),
    '') AS companions, true AS multi_target
  FROM u, (VALUES ('a'), ('b')) AS v(t)""".replace("list_distinct_in_order(list_concat(list_filter(ids, lambda x: x <> id), list_filter(['a', 'b'], lambda x: x <> t)))", "list_filter(list_concat(list_filter(ids, lambda x: x <> id), list_filter(['a', 'b'], lambda x: x <> t)), lambda x, k: list_position(list_concat(list_filter(ids, lambda y: y <> id), list_filter(['a', 'b'], lambda y: y <> t)), x) = k)"))
def explode_targets(t):
    """Holders with the names at their places (the last one where there are too few), then two targets each, whose companions join the holders'."""
    cells = t.part.select(
        "p_partkey", F.replace("p_name", F.lit(" "), F.lit(",")).alias("id"), F.replace("p_type", F.lit(" "), F.lit(",")).alias("name"),
        F.lit("a, b").alias("target"), F.lit("x, y").alias("target_name")
    )
    held = O.explode_multi_value(cells, "id", "name")
    return O.explode_targets(held, "target", "target_name").drop("target_name")


@query("""WITH d AS (SELECT s_suppkey, n_regionkey AS block, s_nationkey + 100 * (s_suppkey % 3) AS ref FROM supplier
  JOIN nation ON s_nationkey = n_nationkey), fixes(block, ref, fixed) AS (VALUES (1, 101, 1), (2, 208, 8), (3, 106, 6))
  SELECT s_suppkey, d.block, CASE WHEN s_suppkey % 3 = 0 THEN d.ref ELSE coalesce(f.fixed, d.ref) END AS ref,
    CASE WHEN s_suppkey % 3 = 0 THEN 'kept' WHEN f.fixed IS NOT NULL THEN 'fixed' ELSE 'unresolved' END AS repaired FROM d
    LEFT JOIN fixes f ON f.block = d.block AND f.ref = d.ref""")
def repair_with_fixes(t):
    """References that are wrong in known ways, put right by a list of (block, reference, right one)."""
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_regionkey").alias("block"), (F.col("s_nationkey") + 100 * (F.col("s_suppkey") % 3)).alias("ref")
    )
    valid = t.nation.select(F.col("n_regionkey").alias("block"), F.col("n_nationkey").alias("ref"))
    fixes = t.spark.createDataFrame([(1, 101, 1), (2, 208, 8), (3, 106, 6)], "block int, ref int, fixed int").select(
        *(
            F.col(c).cast(
                rows.schema["ref"].dataType if c != "block" else rows.schema["block"].dataType
            ).alias(c) for c in ("block", "ref", "fixed")
        )
    )
    return O.repair_reference(rows, "ref", ["block"], valid, fixes)


@query("""SELECT o_orderkey, nullif(trim(n), '') AS name, try_cast(trim(d) AS DATE) AS day,
  epoch(try_cast(trim(s) AS TIMESTAMP))::BIGINT AS second, CASE lower(trim(y)) WHEN '' THEN NULL WHEN 'true' THEN 'yes' WHEN 'n' THEN 'no'
  WHEN 'so not needed' THEN 'not needed' ELSE lower(trim(y)) END AS success, epoch(o_orderdate::TIMESTAMP)::BIGINT + 3600 AS iso
  FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN ' Ann ' END AS n, CASE o_orderkey % 4 WHEN 0 THEN 'soon'
    WHEN 1 THEN ' ' || o_orderdate::DATE::VARCHAR || ' ' END AS d, CASE o_orderkey % 5 WHEN 0 THEN 'x'
    WHEN 1 THEN o_orderdate::DATE::VARCHAR || ' 01:02:03' END AS s,
    CASE o_orderkey % 6 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'n' WHEN 2 THEN 'so Not Needed' WHEN 3 THEN ' ' WHEN 4 THEN 'Maybe' END AS y FROM orders)""")
def lenient_text(t):
    """Names, dates, timestamps and outcomes as they are written, read leniently."""
    kind = lambda n: F.col("o_orderkey") % n
    day = F.to_date("o_orderdate").cast("string")
    written = t.orders.select(
        "o_orderkey", F.when(kind(3) == 0, "  ").when(kind(3) == 1, " Ann ").alias("n"),
        F.when(kind(4) == 0, "soon").when(kind(4) == 1, F.concat(F.lit(" "), day, F.lit(" "))).alias("d"),
        F.when(kind(5) == 0, "x").when(kind(5) == 1, F.concat(day, F.lit(" 01:02:03"))).alias("s"),
        F.when(kind(6) == 0, " TRUE ").when(kind(6) == 1, "n").when(kind(6) == 2, "so Not Needed").when(kind(6) == 3, " ").when(kind(6) == 4, "Maybe").alias("y"),
        F.concat(day, F.lit("T01:00:00Z")).alias("i"),
    )
    return written.select(
        "o_orderkey", T.clean_name(F.col("n")).alias("name"), T.lenient_date(F.col("d")).alias("day"),
        F.unix_timestamp(T.lenient_timestamp(F.col("s"))).alias("second"), T.success_label(F.col("y")).alias("success"),
        F.unix_timestamp(T.iso_timestamp(F.col("i"))).alias("iso")
    )


@query("""WITH p AS (SELECT o_orderstatus AS label, CASE WHEN o_orderkey % 5 = 0 THEN 'P' WHEN o_orderkey % 7 = 0 THEN 'X'
  ELSE o_orderstatus END AS said FROM orders), classes AS (SELECT label AS class FROM p UNION SELECT said FROM p),
  n AS (SELECT class, count(*) FILTER (WHERE label = class) AS support, count(*) FILTER (WHERE said = class) AS claimed,
    count(*) FILTER (WHERE label = class AND said = class) AS hit FROM classes, p GROUP BY class)
  SELECT class, round(coalesce(hit / nullif(claimed, 0), 0), 9) AS precision, round(coalesce(hit / nullif(support, 0), 0), 9) AS recall,
    round(coalesce(2 * hit / nullif(support + claimed, 0), 0), 9) AS f1, support, (SELECT round(avg((label = said)::INT),
    9) FROM p) AS accuracy FROM n""")
def classification_report(t):
    """The report of a prediction: what the trained baseline's held-out rows go through."""
    key = F.col("o_orderkey")
    rows = t.orders.select(
        F.col("o_orderstatus").alias("label"),
        F.when(key % 5 == 0, "P").when(key % 7 == 0, "X").otherwise(F.col("o_orderstatus")).alias("said")
    )
    found = O.classification_report(rows, "label", "said")
    return found.withColumns({c: F.round(c, 9) for c in ("precision", "recall", "f1", "accuracy")})


@query(
    sql_over(
        """SELECT 'votes' AS dataset, unnest(['place', 'day']) AS column_name, unnest(['missing', 'extra']) AS problem UNION ALL SELECT 'votes',
          'episode', 'int instead of bigint'"""
    )
)
def schema_report(t):
    """How the columns of a table differ from those expected."""
    votes = bronze(t, "vote_history")["vote_history"].select("castaway_id", "episode", "day")
    found = O.schema_differences(votes.schema, StructType.fromDDL("castaway_id string, episode bigint, place string"))
    return t.spark.createDataFrame([("votes", c, p) for c, p in found], "dataset string, column_name string, problem string")
