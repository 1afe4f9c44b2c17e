"""Line dedup: removal of boilerplate lines that spread over many sites, in DataFrame operations only.

Each distinct line gets a HyperLogLog sketch of the sites that hold it; sketches are built per task and merged by
the aggregation, so a line that every document holds costs one row for each task. Where the estimate is near the
threshold, distinct sites are counted exactly. A line over the threshold stays in the document with the least id that
holds it and goes from all others, so no passage is lost altogether.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Distinct sites from which on a line is boilerplate.
MIN_SITES = 5
#: Characters that a line must have unless the caller says otherwise: every line that isn't blank.
MIN_CHARS = 1
#: Estimates within this share of the threshold are settled by exact counts; about four standard errors at LG_K.
MARGIN = 0.2
LG_K = 10
#: Parts that the documents of a line are dealt to where lines meet a list of lines, so that a line of every document isn't one task's.
SALTS = 16


def _lines(docs: DataFrame, id: str, text: str, site: str, min_chars: int) -> DataFrame:
    line = F.btrim("_line", F.lit(" \t\r\x0b\x0c"))
    out = docs.select(F.col(id).alias("_id"), F.xxhash64(text).alias("_text"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("_site"), F.posexplode(F.split(text, "\n")).alias("_at", "_line"))
    return out.withColumn("_line", line).where(F.char_length("_line") >= max(min_chars, 1)).withColumn("_hash", F.xxhash64("_line", F.char_length("_line"))).drop("_line")


def _among(lines: DataFrame, listed: DataFrame) -> DataFrame:
    """``lines`` joined with ``listed`` by hash; each listed line is there for each part of the documents."""
    salted = listed.withColumn("_salt", F.explode(F.array(*map(F.lit, range(SALTS)))))
    return lines.withColumn("_salt", F.pmod(F.xxhash64("_id", "_text"), F.lit(SALTS)).cast("int")).join(salted, ["_hash", "_salt"]).drop("_salt")


def spread_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """Lines (by hash) that at least ``min_sites`` sites hold, with the least document id that has them."""
    lines = _lines(docs, id, text, site, min_chars)
    spread = lines.groupBy("_hash").agg(F.hll_sketch_estimate(F.hll_sketch_agg("_site", F.lit(LG_K))).alias("_sites"), F.min("_id").alias("_first"))
    low, high = min_sites * (1 - MARGIN), min_sites * (1 + MARGIN)
    far = spread.where(F.col("_sites") > high)
    near = spread.where(F.col("_sites").between(low, high))
    pairs = _among(lines, near.select("_hash")).groupBy("_hash", "_site").agg(F.min("_id").alias("_first"))
    exact = pairs.groupBy("_hash").agg(F.count(F.lit(1)).alias("_sites"), F.min("_first").alias("_first")).where(F.col("_sites") >= min_sites)
    return far.unionByName(exact).select("_hash", "_first")


def dedup_lines(docs: DataFrame, *, id: str = "doc_id", text: str = "text", site: str = "source", min_sites: int = MIN_SITES, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with boilerplate lines taken out of ``text``, and ``n_lines`` and ``n_removed``; no row goes.

    Lines are compared without surrounding white space; those under ``min_chars`` characters, and blank ones, stay. A null text stays null
    and has no lines; an empty text has one. A null site is a site of its own; a null id counts as greater than any.
    Rows with equal ids and texts are treated alike. Own columns named n_lines or n_removed give way.
    """
    docs = docs.drop("n_lines", "n_removed")
    spread = spread_lines(docs, id=id, text=text, site=site, min_sites=min_sites, min_chars=min_chars)
    gone = _among(_lines(docs, id, text, site, min_chars), spread).where(~F.col("_id").eqNullSafe(F.col("_first")))
    gone = gone.groupBy("_id", "_text").agg(F.collect_set("_at").alias("_gone"))
    rows = docs.select(F.struct("*").alias("row"), F.col(id).alias("id"), F.col(text).alias("text"), F.xxhash64(text).alias("own"))
    joined = rows.join(gone, F.col("id").eqNullSafe(F.col("_id")) & (F.col("own") == F.col("_text")), "left")
    joined = joined.select("row", "text", "_gone", F.split("text", "\n").alias("lines"))
    places = F.sequence(F.lit(0), F.size("lines") - 1)
    stay = F.array_join(F.transform(F.array_except(places, "_gone"), lambda i: F.get("lines", i)), "\n")
    cleaned = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(stay)
    return joined.select(
        *(cleaned.alias(c) if c == text else F.col("row").getField(c).alias(c) for c in docs.columns),
        F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).alias("n_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).alias("n_removed"),
    )
