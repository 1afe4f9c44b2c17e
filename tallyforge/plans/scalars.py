"""Keys, buckets, casts, conditional aggregates."""

from pyspark.sql import functions as F

from .. import functions as T
from .registry import query


@query(
    """SELECT o_orderkey, md5(concat(coalesce(o_orderkey::VARCHAR, ''), '|', coalesce(nullif(o_orderstatus, 'O'), ''), '|', coalesce(o_custkey::VARCHAR,
    ''))) AS order_sk FROM orders"""
)
def surrogate_key(t):
    return t.orders.select(
        "o_orderkey",
        T.surrogate_key(F.col("o_orderkey"), F.nullif(F.col("o_orderstatus"), F.lit("O")), F.col("o_custkey")).alias("order_sk")
    )


@query("""SELECT p_partkey, CASE WHEN p_type ILIKE '%brass%' THEN 'brass' WHEN p_type ILIKE '%steel%' THEN 'steel'
  WHEN p_type ILIKE 'promo%' THEN 'promo' ELSE 'other' END AS bucket,
length(p_name)::INT AS name_length, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_band FROM part""")
def like_buckets(t):
    ladder = [("%brass%", "brass"), ("%steel%", "steel"), ("promo%", "promo")]
    return t.part.select(
        "p_partkey", T.bucket(F.col("p_type"), ladder, "other").alias("bucket"), F.length("p_name").alias("name_length"),
        T.band(F.col("p_size"), [(10, "small"), (30, "medium")], "large").alias("size_band")
    )


@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, count(*) FILTER (WHERE l_discount > 0.05) AS n_deep,
  round(count(*) FILTER (WHERE l_discount > 0.05)::DOUBLE / nullif(count(*), 0), 9) AS deep_share
FROM lineitem GROUP BY 1, 2""")
def filtered_counts_ratios(t):
    deep = F.count_if(F.col("l_discount") > 0.05)
    n = F.count(F.lit(1))
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(n.alias("n"), deep.alias("n_deep"), F.round(T.ratio(deep, n), 9).alias("deep_share"))


@query("""SELECT o_custkey, sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END)::BIGINT AS n_final, count(*) AS n_orders,
  round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS final_value,
round(avg(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 4) AS final_mean FROM orders GROUP BY 1""")
def conditional_sums(t):
    final = F.col("o_orderstatus") == "F"
    return t.orders.groupBy("o_custkey").agg(
        F.sum(T.flag(final)).alias("n_final"), F.count(F.lit(1)).alias("n_orders"),
        F.round(F.sum(F.when(final, F.col("o_totalprice")).otherwise(0.0)), 2).alias("final_value"),
        F.round(F.avg(F.when(final, F.col("o_totalprice"))), 4).alias("final_mean")
    )


@query(
    """SELECT c_mktsegment, round(avg(c_acctbal), 6) AS mean, min(c_acctbal) AS least, max(c_acctbal) AS greatest, round(stddev_samp(c_acctbal),
    6) AS deviation, count(DISTINCT c_nationkey) AS n_nations FROM customer GROUP BY 1"""
)
def distribution_stats(t):
    c = F.col("c_acctbal")
    return t.customer.groupBy("c_mktsegment").agg(
        F.round(F.avg(c), 6).alias("mean"), F.min(c).alias("least"), F.max(c).alias("greatest"), F.round(F.stddev(c), 6).alias("deviation"),
        F.count_distinct("c_nationkey").alias("n_nations")
    )


@query("""SELECT event_id, CASE WHEN lower(trim(v)) IN ('true','t','yes','y','1','on') OR try_cast(trim(v) AS DOUBLE) = 1 THEN true
  WHEN lower(trim(v)) IN ('false','f','no','n','0','off') OR try_cast(trim(v) AS DOUBLE) = 0 THEN false END AS as_boolean,
CASE WHEN try_cast(trim(v) AS DOUBLE) = floor(try_cast(trim(v) AS DOUBLE)) THEN try_cast(trim(v) AS DOUBLE)::INT END AS as_integer,
  try_cast(trim(v) AS DOUBLE) AS as_double,
CASE WHEN lower(trim(v)) NOT IN ('', 'none', 'null', 'nan') THEN trim(v) END AS as_id
FROM (SELECT event_id, CASE (event_id % 7)::INT WHEN 0 THEN ' Yes ' WHEN 1 THEN '3.0' WHEN 2 THEN (event_id % 50)::VARCHAR WHEN 3 THEN ' none '
  WHEN 4 THEN '2.5' WHEN 5 THEN event_type END AS v FROM events)""")
def lenient_casts(t):
    kind = F.col("event_id") % 7
    v = F.when(kind == 0, " Yes ").when(kind == 1, "3.0").when(
        kind == 2, (F.col("event_id") % 50).cast("string")
    ).when(kind == 3, " none ").when(kind == 4, "2.5").when(kind == 5, F.col("event_type"))
    return t.events.select("event_id", v.alias("v")).select(
        "event_id", T.lenient_boolean(F.col("v")).alias("as_boolean"), T.lenient_integer(F.col("v")).alias("as_integer"),
        T.lenient_double(F.col("v")).alias("as_double"), T.clean_id(F.col("v")).alias("as_id")
    )


@query("""SELECT 'quantity_price' AS pair, round(corr(l_quantity, l_extendedprice), 9) AS correlation FROM lineitem UNION ALL
SELECT 'discount_tax', round(corr(l_discount, l_tax), 9) FROM lineitem UNION ALL SELECT 'constant', NULL""")
def correlations_union(t):
    pairs = {"quantity_price": ("l_quantity", "l_extendedprice"), "discount_tax": ("l_discount", "l_tax")}
    lines = t.lineitem.withColumn("one", F.lit(1.0))
    cells = [
        F.struct(F.lit(k).alias("pair"), F.round(T.correlation(F.col(a), F.col(b)), 9).alias("correlation")) for k,
        (a, b) in {**pairs, "constant": ("one", "l_tax")}.items()
    ]
    return lines.agg(F.array(*cells).alias("all")).select(F.inline("all"))


@query("""WITH b AS (SELECT min(c_acctbal) AS lo, max(c_acctbal) AS hi FROM customer)
SELECT least(15, greatest(1, 1 + floor((c_acctbal - lo) / nullif(hi - lo, 0) * 15)))::BIGINT AS bin, count(*) AS n FROM customer, b GROUP BY 1""")
def histogram(t):
    bounds = t.customer.agg(F.min("c_acctbal").alias("lo"), F.max("c_acctbal").alias("hi"))
    place = (F.col("c_acctbal") - F.col("lo")) / F.nullif(F.col("hi") - F.col("lo"), F.lit(0.0)) * 15
    return t.customer.crossJoin(F.broadcast(bounds)).select(
        F.least(F.lit(15), F.greatest(F.lit(1), 1 + F.floor(place))).cast("long").alias("bin")
    ).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def topk(t):
    return t.orders.select("o_custkey", "o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) <> 1")
def having_assert(t):
    return t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.count(F.lit(1)).alias("n")).where("n <> 1")


@query(
    """SELECT e.user_id, date_trunc('day', ts)::DATE AS day, sum(value) AS total FROM events e WHERE event_type IN ('click', 'purchase',
      'view') AND value IS NOT NULL AND value BETWEEN 1 AND 1000 AND NOT (event_type = 'view' AND value > 500) GROUP BY 1, 2"""
)
def filters(t):
    kept = t.events.where(
        F.col("event_type").isin("click", "purchase", "view") & F.col("value").isNotNull() & F.col("value").between(1, 1000) & ~(
            (F.col("event_type") == "view") & (F.col("value") > 500)
        )
    )
    return kept.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.sum("value").alias("total"))
