"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame operations only.

A sketch retains every shingle hash below a fixed fraction of the hash range, whatever the text's length, and the LEAST least ones
besides, which are all hashes of a short text. Both levels merge: the sketch of two texts together is made from their sketches
alone. Up to its limit (the fixed one or, where that is greater, its last hash) a sketch knows every hash of its text, so two
sketches compare exactly up to the lower limit: the share of the smaller side's hashes there that the other has estimates how much of
the smaller text the larger one contains.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

#: Words of a shingle.
SHINGLE = 5
#: Bits of a hash; one in SCALE hashes, those below LIMIT, is retained, and the LEAST least.
BITS = 48
SCALE = 16
LIMIT = (1 << BITS) // SCALE
LEAST = 64
#: Rows of a bucket of consecutive ids, about; there are _FAN * _FAN buckets at most, and more rows in each beyond.
BUCKET_ROWS = 1000
_FAN = 256


def _retained(ordered: Column) -> Column:
    return F.filter(ordered, lambda h, i: (h < LIMIT) | (i < LEAST))


def with_sketch(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds the sorted array of retained shingle hashes; an own column named ``out`` gives way.

    A text under five words is one shingle; one without words (or null) has an empty array. Equal texts have equal sketches.
    """
    rows = df.select(F.struct(*(F.col(c) for c in df.columns if c != out)).alias("row"), F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), "[ \\t-\\r]+"), "").alias("words"))
    n, least = F.size("words"), F.lit((1 << BITS) - 1)
    shingle = F.transform(F.slice("words", 1, F.greatest(n - (SHINGLE - 1), F.lit(0))), lambda x, i: F.xxhash64(x, *(F.get("words", i + k) for k in range(1, SHINGLE))).bitwiseAND(least))
    short = F.array(F.xxhash64(F.array_join("words", " ")).bitwiseAND(least))
    hashes = F.when(n >= SHINGLE, shingle).when(n > 0, short).otherwise(F.array().cast("array<bigint>"))
    rows = rows.select("row", F.sort_array(F.array_distinct(hashes)).alias("ordered"))
    return rows.select("row.*", _retained(F.col("ordered")).alias(out))


def merged(a: Column | str, b: Column | str) -> Column:
    """The sketch of two texts' shingles together, from their sketches."""
    return _retained(F.sort_array(F.array_union(a, b)))


def as_text(sketch: str) -> Column:
    """12 hexadecimal digits for each retained hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), BITS // 4, "0")), "")


def limit(sketch: str) -> Column:
    """The hash up to which a sketch has all of its text."""
    return F.when(F.size(sketch) < LEAST, F.lit(1 << BITS)).otherwise(F.greatest(F.lit(LIMIT - 1), F.element_at(sketch, -1)))


def likeness(a: str, b: str) -> Column:
    """Estimated share of the smaller text's shingles that the other has; two empty sketches are alike, an empty one is unlike any other.

    Exact where both texts have fewer than LEAST shingles. Where a short text has no hash up to the other's limit, nothing speaks for likeness: 0.
    """
    upto = F.least(limit(a), limit(b))
    x, y = (F.filter(c, lambda h: h <= upto) for c in (a, b))
    least = F.least(F.size(x), F.size(y))
    return F.when(least > 0, F.size(F.array_intersect(x, y)) / least).when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(0.0)


def _with_bucket(docs: DataFrame) -> DataFrame:
    """Adds ``bucket``: buckets of consecutive ids of about equal size, by approximate quantiles. Null ids are in the first."""
    n = docs.count()
    wanted = max(1, min(_FAN * _FAN, n // BUCKET_ROWS))
    cuts = docs.select(F.col("order.id").alias("id")).approxQuantile("id", [k / wanted for k in range(1, wanted)], 0.1 / wanted) if wanted > 1 else []
    cuts = sorted({int(x) for x in cuts})
    fine = [cuts[i : i + _FAN] for i in range(0, len(cuts), _FAN)] or [[]]
    many = lambda values: F.array(*map(F.lit, values)).cast("array<bigint>")
    passed = lambda values: F.size(F.filter(values, lambda c: c <= F.coalesce(F.col("order.id"), F.lit(-(1 << 63)))))
    docs = docs.withColumn("coarse", passed(many(x[-1] for x in fine[:-1])))
    return docs.withColumn("bucket", F.col("coarse") * _FAN + passed(F.get(F.array(*map(many, fine)), F.col("coarse")))).drop("coarse")


def with_next(docs: DataFrame, *, id: str = "doc_id", text: str = "text", carry: str | None = None) -> DataFrame:
    """Adds ``next_text`` (and ``next_<carry>``, of a sketch of ``text``): those of the row that follows in ascending ``id``, after the last the first.

    Ids are whole numbers (another type is an error). Ids that repeat follow each other in the order of their text's hash; null
    ids come first. Each row is shuffled once, by buckets of consecutive ids; what follows a bucket is the first row of the
    next. Own columns with the added names give way. An empty table gives no rows.
    """
    if not isinstance(docs.schema[id].dataType, IntegralType):
        raise TypeError(f"{id} must be whole numbers")
    docs = docs.drop("next_text", f"next_{carry}") if carry else docs.drop("next_text")
    rows = docs.select(F.struct("*").alias("row"), F.struct(F.col(id).cast("long").alias("id"), F.xxhash64(text).alias("hash")).alias("order"))
    rows, own = _with_bucket(rows), F.col("row").getField(text)
    first = rows.groupBy("bucket").agg(F.min_by(own, "order").alias("first"))
    order = Window.orderBy("bucket")  # a row for each bucket
    buckets = rows.select("bucket").distinct()
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    follow = buckets.withColumn("after", F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(whole)))
    first = follow.join(first.withColumnRenamed("bucket", "after"), "after").drop("after")
    if carry:
        first = with_sketch(first, "first", "first_carry")
    inside = Window.partitionBy("bucket").orderBy("order")
    rows = rows.withColumn("follows", F.lead(F.struct(own.alias("text"), *([F.col("row").getField(carry).alias("carry")] if carry else []))).over(inside))
    rows = rows.join(first, "bucket")
    last = F.col("follows").isNull()
    added = [F.when(last, F.col("first")).otherwise(F.col("follows.text")).alias("next_text")]
    if carry:
        added.append(F.when(last, F.col("first_carry")).otherwise(F.col("follows.carry")).alias(f"next_{carry}"))
    return rows.select("row.*", *added)


def edited(text: Column, following: Column) -> Column:
    """The text with its last quarter (of code points, rounded down) replaced by as many from the start of ``following``, or all of it."""
    quarter = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - quarter), F.substring(following, F.lit(1), quarter))
