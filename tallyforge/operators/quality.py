"""Data quality: profiles, keys, references, coverage, schemas, changes. Reports are DataFrames."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import functions as T


def _n_null(column: str) -> Column:
    return F.count_if(F.col(column).isNull())


def _n_duplicate(column: str) -> Column:
    distinct = F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))
    return F.count(F.lit(1)) - distinct


def value_counts(df: DataFrame) -> DataFrame:
    """Rows (column_name, value, n) of all columns, as text, null included: tasks count before anything is shuffled, so a column of few values sends few rows."""
    values = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in df.columns))
    return df.select(F.inline(values)).groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))


def profile(df: DataFrame) -> DataFrame:
    """A row for each column: ``n_rows``, ``n_null`` and ``n_duplicate`` (rows less distinct values, null being a value), all in one pass. A table without rows gives zeros."""
    counts = value_counts(df).groupBy("column_name").agg(
        F.sum("n").alias("n_rows"), F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("n_null"),
        (F.sum("n") - F.count(F.lit(1))).alias("n_duplicate")
    )
    names = df.sparkSession.createDataFrame([(c,) for c in df.columns], "column_name string")
    return names.join(counts, "column_name", "left").fillna(0)


def rule_parts(rule: str) -> tuple[str, str, int]:
    """Kind (missing or duplicate), column and wanted count of a rule."""
    kind, column, wanted = re.fullmatch(r"(missing|duplicate)_count\((\w+)\)\s*=\s*(\d+)", rule.strip()).groups()
    return kind, column, int(wanted)


def run_rules(df: DataFrame, rules: list[str]) -> DataFrame:
    """Outcome of rules like ``missing_count(column) = 0`` and ``duplicate_count(column) = 0``, in one pass over the columns they name; a rule on a missing column fails."""
    found = []
    for rule in rules:
        kind, column, wanted = rule_parts(rule)
        value = (_n_null if kind == "missing" else _n_duplicate)(column) if column in df.columns else F.lit(None)
        found.append(F.struct(F.lit(rule).alias("rule"), value.cast("long").alias("found"), F.lit(wanted).alias("_wanted")))
    if not found:
        return df.sparkSession.createDataFrame([], "rule string, found long, passed boolean")
    rows = df.agg(F.array(*found).alias("_all")).select(F.inline("_all"))
    return rows.select("rule", "found", F.coalesce(F.col("found") == F.col("_wanted"), F.lit(False)).alias("passed"))


def duplicates_of_key(df: DataFrame, keys: list[str], nullable: list[str] = ()) -> DataFrame:
    """Keys that several rows have (``n_rows``), and those with a null where none may be. Rows with a null in a nullable part are exempt."""
    strict = [k for k in keys if k not in nullable]
    has_null = F.lit(False)
    for k in strict:
        has_null = has_null | F.col(k).isNull()
    counts = df.dropna(subset=list(nullable)) if nullable else df
    counts = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("problem", F.when(has_null, "null in key").when(F.col("n_rows") > 1, "duplicate")).where(F.col("problem").isNotNull())


def foreign_key_violations(child: DataFrame, keys: list[str], parent: DataFrame, parent_keys: list[str]) -> DataFrame:
    """Distinct keys of ``child`` that ``parent`` lacks, with the number of rows. Keys with a null are no violations."""
    known = parent.select(*(F.col(p).alias(k) for k, p in zip(keys, parent_keys))).distinct()
    return child.dropna(subset=keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).join(known, keys, "left_anti")


def coverage(actual: DataFrame, expected: DataFrame, column: str) -> DataFrame:
    """Values that only one side has: ``missing`` or ``unexpected``."""
    value = lambda df: df.select(F.trim(F.col(column).cast("string")).alias("value")).where(F.col("value") != "").distinct()
    both = value(actual).withColumn("_a", F.lit(1)).join(value(expected).withColumn("_e", F.lit(1)), "value", "full")
    return both.where(F.col("_a").isNull() | F.col("_e").isNull()).select(
        "value", F.when(F.col("_a").isNull(), "missing").otherwise("unexpected").alias("status")
    )


def schema_differences(actual: StructType, expected: StructType, optional: list[str] = ()) -> list[tuple[str, str]]:
    """(column, problem) pairs: missing, extra, or another type."""
    have, want = {f.name: f.dataType for f in actual.fields}, {f.name: f.dataType for f in expected.fields}
    out = [(c, "missing") for c in want if c not in have and c not in optional] + [(c, "extra") for c in have if c not in want]
    return out + [(c, f"{have[c].simpleString()} instead of {want[c].simpleString()}") for c in want if c in have and have[c] != want[c]]


def value_changes(before: DataFrame, after: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """A row for each changed value: key, ``column_name``, ``before``, ``after`` (as text) and ``became_null``. A row that one side has alone has all its values changed, from null or to null."""
    a, b = before.select(
        key, *(F.col(c).cast("string").alias(f"a_{c}") for c in columns)
    ), after.select(key, *(F.col(c).cast("string").alias(f"b_{c}") for c in columns))
    pairs = F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(f"a_{c}").alias("before"), F.col(f"b_{c}").alias("after")) for c in columns))
    out = a.join(b, key, "full").select(key, F.inline(pairs))
    return out.where(T.changed(F.col("before"), F.col("after"))).withColumn("became_null", F.col("after").isNull())


def source_changes(current: DataFrame, stored: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """``status`` of each source: new, changed, unchanged or gone."""
    a = current.select(key, *(F.col(c).alias(f"a_{c}") for c in compared), F.lit(1).alias("_a"))
    b = stored.select(key, *(F.col(c).alias(f"b_{c}") for c in compared), F.lit(1).alias("_b"))
    differs = F.lit(False)
    for c in compared:
        differs = differs | T.changed(F.col(f"a_{c}"), F.col(f"b_{c}"))
    status = F.when(F.col("_b").isNull(), "new").when(F.col("_a").isNull(), "gone").when(differs, "changed").otherwise("unchanged")
    return a.join(b, key, "full").select(key, status.alias("status"))


def classification_report(predictions: DataFrame, label: str, prediction: str) -> DataFrame:
    """A row for each class: precision, recall, f1 and support, and ``accuracy`` over all rows; measures without any case are 0. Rows with a null in either column don't count."""
    rows = predictions.select(F.col(label).alias("label"), F.col(prediction).alias("said")).dropna()
    hits = rows.groupBy("label", "said").agg(F.count(F.lit(1)).alias("n"))
    sides = hits.select(F.explode(F.array(F.struct(F.col("label").alias("class"), F.col("n").alias("real"), F.lit(0).cast("long").alias("claimed"), F.when(F.col("label") == F.col("said"), F.col("n")).otherwise(0).alias("hit")),
                                          F.struct(F.col("said").alias("class"), F.lit(0).cast("long").alias("real"), F.col("n").alias("claimed"), F.lit(0).cast("long").alias("hit")))).alias("s")).select("s.*")
    per = sides.groupBy("class").agg(*(F.sum(c).alias(c) for c in ("real", "claimed", "hit")))
    whole = hits.agg((F.sum(F.when(F.col("label") == F.col("said"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))
    share = lambda a, b: F.coalesce(T.ratio(a, b), F.lit(0.0))
    hit, real, claimed = F.col("hit"), F.col("real"), F.col("claimed")
    return per.crossJoin(F.broadcast(whole)).select("class", share(hit, claimed).alias("precision"), share(hit, real).alias("recall"), share(2 * hit, real + claimed).alias("f1"), real.alias("support"), "accuracy")  # one row
