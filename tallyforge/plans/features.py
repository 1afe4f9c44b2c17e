"""Windows, groups, context and feature matrices."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import functions as T
from .. import operators as O
from ..staging import staged
from .registry import query


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate NULLS LAST, o_orderkey) AS a,
  row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC) AS z FROM orders)
SELECT f.o_custkey, f.o_orderkey AS first_order, l.o_orderkey AS last_order FROM r f JOIN r l ON f.o_custkey = l.o_custkey AND f.a = 1 AND l.z = 1""")
def first_last_record(t):
    first = O.first_per_key(t.orders, ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", F.col("o_orderkey").alias("first_order"))
    return first.join(
        O.last_per_key(t.orders, ["o_custkey"], "o_orderdate", "o_orderkey").select("o_custkey", F.col("o_orderkey").alias("last_order")),
        "o_custkey"
    )


@query("""SELECT o_custkey, o_orderkey, (row_number() OVER w)::INT AS occurrence, count(*) OVER (PARTITION BY o_custkey) AS n_occurrences,
  CASE WHEN row_number() OVER w > 1 THEN 1 ELSE 0 END AS is_returning
FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""")
def repeat_flag(t):
    return O.repeat_flags(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "o_orderkey").drop("o_orderdate")


@query(
    """SELECT c_nationkey, c_mktsegment, count(*) AS n_rows, count(*) OVER (PARTITION BY c_nationkey) AS n_groups,
      round(count(*)::DOUBLE / count(*) OVER (PARTITION BY c_nationkey), 9) AS origin_share FROM customer GROUP BY 1, 2"""
)
def groups_per_partition(t):
    return O.origin_composition(t.customer, ["c_nationkey"], "c_mktsegment").withColumn("origin_share", F.round("origin_share", 9))


@query("""WITH e AS (SELECT event_id, user_id AS actor, ts::DATE AS day, nullif(event_type, 'error') AS target FROM events)
SELECT a.day, a.actor, count(*) AS total_others, count(*) FILTER (WHERE a.target = b.target) AS aligned_others,
  round(count(*) FILTER (WHERE a.target = b.target)::DOUBLE / count(*), 9) AS alignment_ratio
FROM e a JOIN e b ON a.day = b.day AND a.actor <> b.actor GROUP BY 1, 2""")
def pairwise_alignment(t):
    e = t.events.select(F.col("user_id").alias("actor"), F.to_date("ts").alias("day"), F.nullif(F.col("event_type"), F.lit("error")).alias("target"))
    return O.pairwise_alignment(e, ["day"], "actor", "target").withColumn("alignment_ratio", F.round("alignment_ratio", 9))


@query("""WITH g AS (SELECT c_nationkey, count(*) AS group_size, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS n,
  count(*) FILTER (WHERE c_mktsegment = 'BUILDING')::DOUBLE / count(*) AS r FROM customer GROUP BY 1)
SELECT c.c_custkey, round(CASE WHEN c_mktsegment = 'BUILDING' THEN r ELSE 1 - r END, 9) AS builder_similarity,
  CASE WHEN CASE WHEN c_mktsegment = 'BUILDING' THEN r ELSE 1 - r END < 0.5 THEN 1 ELSE 0 END AS builder_minority
FROM customer c JOIN g ON c.c_nationkey = g.c_nationkey""")
def group_composition(t):
    holds = {"builder": F.col("c_mktsegment") == "BUILDING"}
    groups = O.group_composition(t.customer, ["c_nationkey"], holds)
    return O.minority_labels(t.customer, groups, ["c_nationkey"], holds).select(
        "c_custkey", F.round("builder_similarity", 9).alias("builder_similarity"), "builder_minority"
    )


@query("""WITH p AS (SELECT l_partkey, avg(l_quantity) AS expected FROM lineitem GROUP BY 1)
SELECT l_orderkey, l_linenumber, round(CASE WHEN expected > 0 THEN l_quantity / expected END, 6) AS ratio_to_expected,
  CASE WHEN l_quantity > expected THEN 1 ELSE 0 END AS over_expected, CASE WHEN l_quantity < expected THEN 1 ELSE 0 END AS under_expected
FROM lineitem l JOIN p ON l.l_partkey = p.l_partkey""")
def expectation_flags(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    q, e = F.col("l_quantity"), F.col("expected")
    joined = lines.join(lines.groupBy("l_partkey").agg(F.avg("l_quantity").alias("expected")), "l_partkey")
    return joined.select(
        "l_orderkey", "l_linenumber", F.round(F.when(e > 0, q / e), 6).alias("ratio_to_expected"), T.flag(q > e).alias("over_expected"),
        T.flag(q < e).alias("under_expected")
    )


@query("""WITH y AS (SELECT o_orderkey, year(o_orderdate)::INT AS y FROM orders), b AS (SELECT min(y) AS lo, max(y) AS hi FROM y)
SELECT o_orderkey, CASE WHEN y < 1994 THEN 'early' WHEN y < 1997 THEN 'middle' ELSE 'late' END AS era, round((y - lo)::DOUBLE / nullif(hi - lo,
  0), 9) AS recency FROM y, b""")
def era_recency_context(t):
    rows = O.with_bounds(t.orders.select("o_orderkey", F.year("o_orderdate").alias("y")), "y")
    return rows.select("o_orderkey", T.band(F.col("y"), [(1994, "early"), (1997, "middle")], "late").alias("era"), F.round("recency", 9).alias("recency"))


@query("""SELECT l_orderkey, l_linenumber, cn.n_name AS customer_nation, sn.n_name AS supplier_nation,
  CASE WHEN cn.n_regionkey = sn.n_regionkey THEN 1 ELSE 0 END AS same_region
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey JOIN nation sn ON s_nationkey = sn.n_nationkey""")
def role_playing_join(t):
    nation = lambda p: t.nation.select(F.col("n_nationkey").alias(f"{p}_nationkey"), F.col("n_name").alias(f"{p}_nation"), F.col("n_regionkey").alias(f"{p}_region"))
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey").join(
        t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    lines = lines.join(
        t.customer.select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey")
    ).join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    lines = lines.join(nation("c"), "c_nationkey").join(nation("s"), "s_nationkey")
    return lines.select(
        "l_orderkey", "l_linenumber", F.col("c_nation").alias("customer_nation"), F.col("s_nation").alias("supplier_nation"),
        T.flag(F.col("c_region") == F.col("s_region")).alias("same_region")
    )


@query(
    """SELECT DISTINCT s_suppkey, m.n_name AS peer_nation FROM supplier LEFT JOIN nation n ON s_nationkey = n.n_nationkey
    LEFT JOIN nation m ON n.n_regionkey = m.n_regionkey"""
)
def fanout_left_join(t):
    own = t.supplier.join(t.nation.select("n_nationkey", "n_regionkey"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
    return own.join(t.nation.select("n_regionkey", F.col("n_name").alias("peer_nation")), "n_regionkey", "left").select("s_suppkey", "peer_nation").distinct()


@query(
    """SELECT l_suppkey AS subject, count(*) AS n_received, count(DISTINCT l_orderkey) AS n_orders, round(sum(l_extendedprice),
    2) AS value_received FROM lineitem GROUP BY 1"""
)
def subject_swap(t):
    return t.lineitem.groupBy(F.col("l_suppkey").alias("subject")).agg(
        F.count(F.lit(1)).alias("n_received"), F.count_distinct("l_orderkey").alias("n_orders"),
        F.round(F.sum("l_extendedprice"), 2).alias("value_received")
    )


def _matrix(t):
    base = t.customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    orders = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"), "o_orderstatus", "o_totalprice")
    lines = t.lineitem.select("l_orderkey", "l_returnflag", "l_quantity", "l_discount")
    per_order = lines.groupBy("l_orderkey").agg(
        F.sum("l_quantity").alias("q"), F.sum(T.flag(F.col("l_returnflag") == "R")).alias("r"), F.count(F.lit(1)).alias("n")
    )
    final = F.col("o_orderstatus") == "F"
    n = F.count(F.lit(1))
    order_part = orders.groupBy("c_custkey").agg(
        n.alias("n_orders"), F.sum(T.flag(final)).alias("n_final"), F.round(T.ratio(F.sum(T.flag(final)), n), 9).alias("final_share"),
        F.round(F.sum("o_totalprice"), 2).alias("order_value")
    )
    joined = orders.join(per_order, F.col("o_orderkey") == F.col("l_orderkey"))
    line_part = joined.groupBy("c_custkey").agg(
        F.sum("n").alias("n_lines"), F.sum("q").alias("quantity"), F.sum("r").alias("n_returned"),
        F.round(T.ratio(F.sum("r"), F.sum("n")), 9).alias("return_share")
    )
    defaults = {"n_orders": 0, "n_final": 0, "final_share": 0.0, "order_value": 0.0, "n_lines": 0, "quantity": 0.0, "n_returned": 0, "return_share": 0.0}
    return O.feature_matrix(base, [order_part, line_part], ["c_custkey"], defaults)


_MATRIX_SQL = """SELECT c_custkey, c_mktsegment, c_acctbal, coalesce(n_orders, 0) AS n_orders, coalesce(n_final, 0) AS n_final,
  coalesce(final_share, 0.0) AS final_share, coalesce(order_value, 0.0) AS order_value,
coalesce(n_lines, 0) AS n_lines, coalesce(quantity, 0.0) AS quantity, coalesce(n_returned, 0) AS n_returned, coalesce(return_share,
  0.0) AS return_share FROM customer
LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_final,
  round(count(*) FILTER (WHERE o_orderstatus = 'F')::DOUBLE / count(*), 9) AS final_share, round(sum(o_totalprice),
  2) AS order_value FROM orders GROUP BY 1) o ON c_custkey = o.o_custkey
LEFT JOIN (SELECT o_custkey, count(*) AS n_lines, sum(l_quantity) AS quantity, count(*) FILTER (WHERE l_returnflag = 'R') AS n_returned,
  round(count(*) FILTER (WHERE l_returnflag = 'R')::DOUBLE / count(*), 9) AS return_share
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1) l ON c_custkey = l.o_custkey"""


@query(_MATRIX_SQL)
def feature_matrix(t):
    return _matrix(t)


@query(f"""SELECT m.*, coalesce(n_events, 0) AS n_events, CASE WHEN n_events >= 60 THEN 1 ELSE 0 END AS is_active,
  CASE WHEN n_purchases * 5 > n_events THEN 1 ELSE 0 END AS is_buyer
FROM ({_MATRIX_SQL}) m LEFT JOIN (SELECT user_id, count(*) AS n_events, count(*) FILTER (WHERE event_type = 'purchase') AS n_purchases FROM events
  GROUP BY 1) e ON m.c_custkey = e.user_id""")
def feature_matrix_hybrid(t):
    events = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("event_type") == "purchase").alias("p"))
    joined = _matrix(t).join(events, "c_custkey", "left")
    return joined.select(
        "*", F.coalesce("n", F.lit(0)).alias("n_events"), T.flag(F.col("n") >= 60).alias("is_active"),
        T.flag(F.col("p") * 5 > F.col("n")).alias("is_buyer")
    ).drop("n", "p")


@query("""SELECT user_id, day, n, lag(n, 1) OVER w AS n_before, n - lag(n, 1) OVER w AS change, (sum(n) OVER (PARTITION BY user_id
  ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS n_so_far
FROM (SELECT user_id, ts::DATE AS day, count(*) AS n FROM events GROUP BY 1, 2) WINDOW w AS (PARTITION BY user_id ORDER BY day)""")
def lag_and_cumulative(t):
    w = Window.partitionBy("user_id").orderBy("day")
    days = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    so_far = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return days.select("*", F.lag("n", 1).over(w).alias("n_before"), (F.col("n") - F.lag("n", 1).over(w)).alias("change"), so_far.alias("n_so_far"))


@query("""SELECT l_orderkey, l_linenumber, md5(concat(o_custkey::VARCHAR)) AS customer_sk, md5(concat(l_partkey::VARCHAR)) AS part_sk,
  md5(concat(l_suppkey::VARCHAR)) AS supplier_sk, concat(year(o_orderdate)::VARCHAR, '-', lpad(month(o_orderdate)::VARCHAR, 2, '0')) AS month_key,
  l_quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def star_schema_fact(t):
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    keys = [T.surrogate_key(F.col(c)).alias(a) for c, a in (("o_custkey", "customer_sk"), ("l_partkey", "part_sk"), ("l_suppkey", "supplier_sk"))]
    month = F.concat(F.year("o_orderdate").cast("string"), F.lit("-"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"))
    return lines.select("l_orderkey", "l_linenumber", *keys, month.alias("month_key"), "l_quantity")


@query(
    """SELECT o_custkey, count(*) AS n, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_final,
      coalesce(round(max(o_totalprice) FILTER (WHERE o_orderstatus = 'O'), 2), -1) AS top_open FROM orders GROUP BY 1"""
)
def nested_payload(t):
    per = t.orders.groupBy("o_custkey", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("o_totalprice"), 2).alias("top"))
    maps = per.groupBy("o_custkey").agg(
        F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("o_orderstatus", "n"))).alias("by_status"),
        F.max(F.when(F.col("o_orderstatus") == "O", F.col("top"))).alias("top_open")
    )
    payload = F.to_json(F.struct("n", "by_status", F.struct("top_open").alias("misc")), {"ignoreNullFields": "false"})
    p = F.from_json("payload", "n long, by_status map<string,long>, misc struct<top_open:double>").alias("p")
    read = maps.select("o_custkey", payload.alias("payload")).select("o_custkey", p)
    return read.select(
        "o_custkey", F.col("p.n").alias("n"), F.coalesce(F.try_element_at("p.by_status", F.lit("F")), F.lit(0)).alias("n_final"),
        F.coalesce("p.misc.top_open", F.lit(-1.0)).alias("top_open")
    )


@query()
def train_baseline(t):
    """Random forest on the feature matrix; rows are held-out predictions by class."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    rows = staged(_matrix(t), "matrix").withColumn("label", T.flag(F.col("return_share") > 0.3).cast("double"))  # the split, the fit and the test read it
    rows = VectorAssembler(inputCols=["c_acctbal", "n_orders", "n_final", "order_value", "n_lines", "quantity"], outputCol="features").transform(rows)
    train, test = rows.randomSplit([0.8, 0.2], 42)
    return RandomForestClassifier(numTrees=20, seed=42).fit(train).transform(test).groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
