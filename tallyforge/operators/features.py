"""First and last records, repeats, context, and feature matrices of one row per key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _ranked(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_nth = 1").drop("_nth")


def first_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row of each key that comes first by ``order``; nulls come last."""
    return _ranked(df, keys, [F.col(c).asc_nulls_last() for c in order])


def last_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """The row of each key that comes last by ``order``; nulls count as latest."""
    return _ranked(df, keys, [F.col(c).desc_nulls_first() for c in order])


def repeat_flags(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    """Adds ``occurrence`` (from 1 in ``order``), ``n_occurrences`` and ``is_returning`` (1 from the second on)."""
    key = Window.partitionBy(*keys)
    out = df.withColumn("occurrence", F.row_number().over(key.orderBy(*(F.col(c).asc_nulls_last() for c in order))))
    return out.withColumn("n_occurrences", F.count(F.lit(1)).over(key)).withColumn("is_returning", F.when(F.col("occurrence") > 1, 1).otherwise(0))


def with_bounds(df: DataFrame, value: str) -> DataFrame:
    """Adds the least and greatest ``value`` of all rows (one broadcast row) and ``recency``, its place between them (0 to 1, null if they agree)."""
    bounds = df.agg(F.min(value).alias("least"), F.max(value).alias("greatest"))
    span = F.nullif((F.col("greatest") - F.col("least")).cast("double"), F.lit(0.0))
    return df.crossJoin(F.broadcast(bounds)).withColumn("recency", (F.col(value) - F.col("least")).cast("double") / span)


def feature_matrix(base: DataFrame, parts: list[DataFrame], keys: list[str], defaults: dict[str, object]) -> DataFrame:
    """One row for each row of ``base``: left joins of parts that have a row per key each, with defaults for what is missing."""
    joined = reduce(lambda left, part: left.join(part, keys, "left"), parts, base)
    return joined.fillna({k: v for k, v in defaults.items() if k in joined.columns})
