"""Repairs and references."""

from pyspark.sql import functions as F

from .. import functions as T
from .. import operators as O
from .registry import query


@query(
    """SELECT l_partkey AS part, count(*) AS n_rows FROM lineitem WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part
      WHERE p_partkey = l_partkey AND p_size > 5) GROUP BY 1"""
)
def semi_anti_fk(t):
    return O.foreign_key_violations(t.lineitem.select(F.col("l_partkey").alias("part")), ["part"], t.part.where("p_size > 5"), ["p_partkey"])


@query(
    """SELECT l_orderkey, l_linenumber, CASE WHEN EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey AND p_size > 5) THEN l_partkey END AS l_partkey
    FROM lineitem"""
)
def null_invalid(t):
    return O.null_invalid(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey"), "l_partkey", t.part.where("p_size > 5"), "p_partkey")[0]


@query("SELECT o_orderkey FROM orders o WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)")
def drop_orphans(t):
    return t.orders.join(t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi").select("o_orderkey")


@query(
    """SELECT event_id, user_id, ts::DATE AS day FROM (SELECT *, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts NULLS LAST,
    event_id) AS n FROM events) WHERE n = 1"""
)
def dedupe_keep_first(t):
    events = t.events.select("event_id", "user_id", "ts", F.to_date("ts").alias("day"))
    return O.dedupe_keep_first(events, ["user_id", "day"], "ts", "event_id")[0].drop("ts")


@query("SELECT event_id, count(*) OVER (PARTITION BY user_id, ts::DATE) > 1 AS is_duplicate FROM events")
def flag_duplicates(t):
    return O.flag_duplicates(t.events.select("event_id", "user_id", F.to_date("ts").alias("day")), ["user_id", "day"]).select("event_id", "is_duplicate")


@query("""WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS ws FROM part), u AS (SELECT p_partkey, ws, unnest(ws) AS word FROM w)
SELECT p_partkey, word, len(ws) > 1 AS joint, nullif(array_to_string(list_filter(list_distinct_ordered, lambda x: x <> word), ', '), '') AS companions
FROM (SELECT *, list_filter(ws, lambda x, i: list_position(ws, x) = i) AS list_distinct_ordered FROM u WHERE word <> '')""")
def explode_multi_value(t):
    cells = t.part.select("p_partkey", F.replace("p_name", F.lit(" "), F.lit(",")).alias("word"), F.lit(None).cast("string").alias("name"))
    return O.explode_multi_value(cells, "word", "name").drop("name")


_CHANGED = "(SELECT c_custkey + CASE WHEN c_custkey % 10 = 0 THEN 10000000 ELSE 0 END AS c_custkey, c_name, c_acctbal + 1 AS c_acctbal FROM customer WHERE c_custkey % 5 = 0)"


def _updates(t):
    key = F.col("c_custkey") + F.when(F.col("c_custkey") % 10 == 0, 10000000).otherwise(0)
    return t.customer.where("c_custkey % 5 = 0").select(key.alias("c_custkey"), "c_name", (F.col("c_acctbal") + 1).alias("c_acctbal"))


@query(
    f"SELECT c_custkey, c_name, c_acctbal FROM customer c WHERE NOT EXISTS (SELECT 1 FROM {_CHANGED} u WHERE u.c_custkey = c.c_custkey) UNION ALL SELECT * FROM {_CHANGED}"
)
def upsert_result(t):
    return O.upsert(t.customer.select("c_custkey", "c_name", "c_acctbal"), _updates(t), ["c_custkey"])


@query(
    f"SELECT count(*) FILTER (WHERE c.c_custkey IS NULL) AS n_inserted, count(*) FILTER (WHERE c.c_custkey IS NOT NULL) AS n_updated FROM {_CHANGED} u LEFT JOIN customer c ON c.c_custkey = u.c_custkey"
)
def upsert_counts(t):
    return O.upsert_counts(t.customer.select("c_custkey"), _updates(t), ["c_custkey"])


@query("""SELECT l_partkey AS p_partkey, coalesce(any_value(p_name), arg_min(l_returnflag, l_orderkey * 10 + l_linenumber)) AS label FROM lineitem
  LEFT JOIN (SELECT p_partkey, p_name FROM part WHERE p_size > 20) s ON p_partkey = l_partkey
WHERE NOT EXISTS (SELECT 1 FROM part k WHERE k.p_partkey = l_partkey AND k.p_size > 40) GROUP BY 1""")
def missing_parents(t):
    children = t.lineitem.select(
        F.col("l_partkey").alias("p_partkey"), F.col("l_returnflag").alias("label"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("seq")
    )
    summary = t.part.where("p_size > 20").select("p_partkey", F.col("p_name").alias("label"))
    return O.create_missing_parents(children, t.part.where("p_size > 40").select("p_partkey"), ["p_partkey"], "seq", ["label"], summary)


@query("""WITH d AS (SELECT s_suppkey, n_regionkey AS block, CASE WHEN s_suppkey % 4 = 0 THEN -1 ELSE s_nationkey END AS ref FROM supplier
  JOIN nation ON s_nationkey = n_nationkey),
v AS (SELECT n_regionkey AS block, n_nationkey AS ref FROM nation WHERE n_regionkey <> 0 OR n_nationkey = 0), one AS (SELECT block,
  min(ref) AS sole FROM v GROUP BY 1 HAVING count(DISTINCT ref) = 1)
SELECT s_suppkey, d.block, CASE WHEN v.ref IS NOT NULL THEN d.ref ELSE coalesce(sole, d.ref) END AS ref,
  CASE WHEN v.ref IS NOT NULL THEN 'kept' WHEN sole IS NOT NULL THEN 'candidate' ELSE 'unresolved' END AS repaired
FROM d LEFT JOIN v ON v.block = d.block AND v.ref = d.ref LEFT JOIN one ON one.block = d.block""")
def repair_reference(t):
    rows = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        "s_suppkey", F.col("n_regionkey").alias("block"),
        F.when(F.col("s_suppkey") % 4 == 0, -1).otherwise(F.col("s_nationkey")).alias("ref")
    )
    valid = t.nation.where("n_regionkey <> 0 OR n_nationkey = 0").select(F.col("n_regionkey").alias("block"), F.col("n_nationkey").alias("ref"))
    return O.repair_reference(rows, "ref", ["block"], valid)


@query(
    """SELECT DISTINCT l_orderkey, flag FROM (SELECT l_orderkey, unnest(['deep', 'returned', 'large']) AS flag, unnest([l_discount > 0.05,
      l_returnflag = 'R', l_quantity > 40]) AS held FROM lineitem) WHERE held"""
)
def unpivot_flags(t):
    flags = t.lineitem.select(
        "l_orderkey", (F.col("l_discount") > 0.05).alias("deep"), (F.col("l_returnflag") == "R").alias("returned"),
        (F.col("l_quantity") > 40).alias("large")
    )
    return O.unpivot_flags(flags, ["l_orderkey"], ["deep", "returned", "large"])


@query()
def resolve_ids(t):
    """Supplier names with edits, resolved to suppliers of their nation."""
    people = t.supplier.select(F.col("s_nationkey").alias("block"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("id"))
    kind = F.col("s_suppkey") % 4
    edited = F.when(kind == 0, F.lower("s_name")).when(
        kind == 1, F.concat(F.lit("x"), F.col("s_name"))
    ).when(kind == 2, F.translate("s_name", "e", "é")).otherwise(F.col("s_name"))
    rows = t.supplier.select("s_suppkey", F.col("s_nationkey").alias("block"), edited.alias("name"))
    return O.resolve_ids(rows, people, ["block"], "name", "id")


_CELLS = ["ref", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
_AFTER = """SELECT o_custkey, o.o_orderkey * 10 + k AS seq, CASE WHEN o.o_orderkey % 5 = 0 THEN o.o_orderkey + 1 ELSE o.o_orderkey END AS ref,
  CASE WHEN o.o_orderkey % 3 = 0 THEN 'X' ELSE o.o_orderstatus END AS o_orderstatus,
  CASE WHEN o.o_orderkey % 7 > 0 THEN o.o_totalprice END AS o_totalprice, o_orderdate, CASE WHEN o.o_orderkey % 4 = 0 AND k = 1 THEN 'split'
    ELSE o.o_orderpriority END AS o_orderpriority FROM orders o, (VALUES (0), (1)) AS v(k) WHERE o.o_orderkey % 11 > 0 AND (k = 0
    OR o.o_orderkey % 6 = 2)"""


def _before_and_after(t):
    """Orders of customers, and the same after a repair: some gone, some split, cells changed, the order's number among them."""
    key = F.col("o_orderkey")
    before = t.orders.select("o_custkey", (key * 10).alias("seq"), key.alias("ref"), *_CELLS[1:])
    after = t.orders.where(key % 11 > 0).withColumn("k", F.explode(F.when(key % 6 == 2, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    after = after.select(
        "o_custkey", (key * 10 + F.col("k")).alias("seq"), F.when(key % 5 == 0, key + 1).otherwise(key).alias("ref"),
        F.when(key % 3 == 0, "X").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(key % 7 > 0, F.col("o_totalprice")).alias("o_totalprice"), "o_orderdate",
        F.when((key % 4 == 0) & (F.col("k") == 1), "split").otherwise(F.col("o_orderpriority")).alias("o_orderpriority"),
    )
    return before, after


_PAIRED = f"""before AS (SELECT o_custkey, o_orderkey * 10 AS seq, o_orderkey AS ref, {", ".join(_CELLS[1:])} FROM orders), after AS ({_AFTER}),
  met AS (SELECT a.o_custkey, a.seq AS after_seq, b.seq AS before_seq, list_filter([{", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _CELLS)}], lambda x: x IS NOT NULL) AS changed FROM after a JOIN before b ON a.o_custkey = b.o_custkey),
  paired AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, after_seq ORDER BY len(changed), before_seq) AS nth FROM met) WHERE nth = 1)"""


@query(f"WITH {_PAIRED} SELECT o_custkey, after_seq, before_seq, len(changed)::INT AS n_changed, array_to_string(changed, ', ') AS changed FROM paired")
def row_pairs(t):
    before, after = _before_and_after(t)
    return O.pair_rows(before, after, ["o_custkey"], _CELLS, "seq").withColumn("changed", F.array_join("changed", ", "))


@query(f"""WITH {_PAIRED}, cells AS (SELECT o_custkey, seq, unnest([{", ".join(f"'{c}'" for c in _CELLS)}]) AS column_name, unnest([{", ".join(f"CAST({c} AS VARCHAR)" for c in _CELLS)}]) AS value, side FROM (SELECT *, 'b' AS side FROM before UNION ALL SELECT *, 'a' FROM after))
  SELECT p.o_custkey, 'result' AS state, before_seq, after_seq, b.column_name, b.value AS before, a.value AS after FROM paired p
    JOIN cells b ON b.side = 'b' AND b.o_custkey = p.o_custkey AND b.seq = before_seq JOIN cells a ON a.side = 'a' AND a.o_custkey = p.o_custkey
    AND a.seq = after_seq AND a.column_name = b.column_name WHERE a.value IS DISTINCT FROM b.value
  UNION ALL SELECT o_custkey, 'removed', seq, NULL, column_name, value, NULL FROM cells c WHERE side = 'b' AND NOT EXISTS (SELECT 1 FROM paired p
    WHERE p.o_custkey = c.o_custkey AND p.before_seq = c.seq)
  UNION ALL SELECT o_custkey, 'added', NULL, seq, column_name, NULL, value FROM cells c WHERE side = 'a' AND NOT EXISTS (SELECT 1 FROM paired p
    WHERE p.o_custkey = c.o_custkey AND p.after_seq = c.seq)""")
def row_changes(t):
    before, after = _before_and_after(t)
    return O.row_changes(before, after, ["o_custkey"], _CELLS, "seq")
