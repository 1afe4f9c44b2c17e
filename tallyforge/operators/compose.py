"""Composition of groups, and who is in the minority."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ratio


def group_composition(members: DataFrame, group: list[str], attributes: dict[str, Column]) -> DataFrame:
    """Per group: ``group_size``, and for each attribute the rows where it holds (``n_<name>``) and their share (``<name>_ratio``)."""
    size = F.count(F.lit(1))
    aggs = [size.alias("group_size")]
    for name, holds in attributes.items():
        aggs += [F.count_if(holds).alias(f"n_{name}"), ratio(F.count_if(holds), size).alias(f"{name}_ratio")]
    return members.groupBy(*group).agg(*aggs)


def minority_labels(rows: DataFrame, composition: DataFrame, group: list[str], attributes: dict[str, Column]) -> DataFrame:
    """``rows`` with the share of the group that is alike (``<name>_similarity``) and ``<name>_minority`` (share under one half).

    A null attribute counts as not held.
    """
    out = rows.join(composition, group, "left")
    for name, holds in attributes.items():
        alike = F.when(holds, F.col(f"{name}_ratio")).otherwise(1 - F.col(f"{name}_ratio"))
        out = out.withColumn(f"{name}_similarity", alike).withColumn(f"{name}_minority", F.when(alike < 0.5, 1).otherwise(0))
    return out.select(*rows.columns, *(f"{name}_{kind}" for name in attributes for kind in ("similarity", "minority")))


def groups_per_partition(df: DataFrame, partition: list[str], group: str) -> DataFrame:
    """Per partition and group: ``n_rows``, and ``n_groups`` of the partition."""
    counts = df.groupBy(*partition, group).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.withColumn("n_groups", F.count(F.lit(1)).over(Window.partitionBy(*partition)))


def origin_composition(df: DataFrame, partition: list[str], origin: str, strict: bool = False) -> DataFrame:
    """Per partition and origin: members, and their number over that of the origins; ``strict`` divides by members instead, so shares add up to one."""
    counts = groups_per_partition(df, partition, origin)
    whole = F.sum("n_rows").over(Window.partitionBy(*partition)) if strict else F.col("n_groups")
    return counts.withColumn("origin_share", ratio(F.col("n_rows"), whole))
