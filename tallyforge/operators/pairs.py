"""Who acts together: shares of the other actors of a group that chose the same target."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import ratio


def pairwise_alignment(df: DataFrame, group: list[str], actor: str, target: str, extra_keys: list[str] | None = None) -> DataFrame:
    """Per group, actor and ``extra_keys``: ``total_others``, ``aligned_others`` and ``alignment_ratio``.

    Counts what a self-join on the group with differing actors would, without its square: each row meets the group's rows
    less the actor's own, and aligns with those of its target less the actor's own. The group's and the target's sums are small
    aggregates of the counts, so a large group isn't one task's; the actor's are windows over the actor's own counts, and only where ``extra_keys`` split them.
    Rows with a null actor or group don't count; a null target never aligns; an actor alone in its groups has no row. ``extra_keys``
    split the actor's rows, not the others.
    """
    own, keys = [*group, actor], [*group, actor, *(extra_keys or [])]
    counts = df.dropna(subset=own).groupBy(*keys, target).agg(F.count(F.lit(1)).alias("_n"))
    targets = counts.groupBy(*group, target).agg(F.sum("_n").alias("_target"))
    groups = targets.groupBy(*group).agg(F.sum("_target").alias("_all"))
    both = whole = F.col("_n")
    if extra_keys:
        counts = counts.withColumn("_own", F.sum("_n").over(Window.partitionBy(*own))).withColumn("_both", F.sum("_n").over(Window.partitionBy(*own, target)))
        both, whole = F.col("_both"), F.col("_own")
    met = counts.join(targets, [*group, target], "left").withColumn("_same", F.col("_n") * F.coalesce(F.col("_target") - both, F.lit(0)))
    mine = met.groupBy(*keys).agg(F.sum("_n").alias("_n"), F.sum("_same").alias("aligned_others"), (F.max(whole) if extra_keys else F.sum("_n")).alias("_own"))
    out = mine.join(groups, group).withColumn("total_others", F.col("_n") * (F.col("_all") - F.col("_own"))).where("total_others > 0")
    return out.select(*keys, "total_others", "aligned_others", ratio(F.col("aligned_others"), F.col("total_others")).alias("alignment_ratio"))
