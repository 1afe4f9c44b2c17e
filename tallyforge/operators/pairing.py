"""Rows before and after a change, paired where no key tells which belong together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import staged


#: Rows of ``before`` that a row of ``after`` may meet at once: a block of no more is compared whole.
FEW = 64


def _rows(df: DataFrame, block: list[str], columns: list[str], order: str, name: str) -> DataFrame:
    """Rows as (block, cells, name)."""
    cells = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(columns)))
    return df.select(F.struct(*block).alias("block"), cells.alias("cells"), F.col(order).alias(name))


def _kinds(rows: DataFrame, name: str, alias: str) -> DataFrame:
    """Distinct rows of a block, each with the first ``name`` that has it."""
    return rows.groupBy("block", "cells").agg(F.min(name).alias(alias))


def _cells_hash(group: list[int], g: int) -> Column:
    """Hash of a group of cells; a null counts as a value."""
    return F.xxhash64(F.lit(g), *(x for i in group for x in (F.col(f"cells.c{i}").isNull(), F.col(f"cells.c{i}"))))


def _whole_blocks(before: DataFrame, after: DataFrame, columns: list[str], max_changed: int | None) -> DataFrame:
    """Each row of ``after`` beside all rows of ``before`` in its block: one shuffle of each side, as a block's rows come as a list."""
    lists = before.groupBy(F.col("block").alias("_block")).agg(F.collect_list(F.struct("old", "cells")).alias("olds"))
    met = after.join(lists, F.col("block") == F.col("_block"), "left")  # blocks are structs, so null ones are equal here
    unlike = lambda cells, i: ~F.col(f"cells.c{i}").eqNullSafe(cells.getField(f"c{i}"))
    n = lambda cells: reduce(Column.__add__, (unlike(cells, i).cast("int") for i in range(len(columns))))
    best = F.array_min(F.transform("olds", lambda x: F.struct(n(x["cells"]).alias("n"), x["old"].alias("old"), x["cells"].alias("cells"))))
    met = met.select("block", "row", "cells", best.alias("best"))
    if max_changed is not None:
        met = met.withColumn("best", F.when(F.col("best.n") <= max_changed, F.col("best")))
    changed = F.filter(F.array(*(F.when(unlike(F.col("best.cells"), i), c) for i, c in enumerate(columns))), lambda x: x.isNotNull())
    return met.select("block", "row", "cells", F.col("best.old").alias("old"), F.col("best.cells").alias("old_cells"), F.when(F.col("best").isNotNull(), changed).alias("changed"))


def _by_rounds(before: DataFrame, after: DataFrame, columns: list[str], max_changed: int | None) -> DataFrame:
    """As ``_whole_blocks``, without ``old_cells``, for blocks of any size.

    If two rows differ in d columns at most, then of d + 1 groups of columns one agrees, so round d joins equal groups, and
    rows whose partner is that near leave. Rows that agree in all columns are looked at once. The columns with most values are dealt to different
    groups, so groups are selective. Work is linear while changes are few; a row like no other meets those that share a cell with it.
    """
    c = len(columns)
    old, new = staged(_kinds(before, "old", "old"), "before"), staged(_kinds(after, "row", "new"), "after")
    many = old.agg(*(F.approx_count_distinct(f"cells.c{i}").alias(f"c{i}") for i in range(c))).first()
    by_values = sorted(range(c), key=lambda i: (-many[i], i))
    differ = [(~F.col(f"a.c{i}").eqNullSafe(F.col(f"b.c{i}"))) for i in range(c)]
    found, left = [], new
    for d in range(min(c, c if max_changed is None else max_changed + 1)):
        groups = [by_values[g :: d + 1] for g in range(d + 1)]
        keyed = lambda df: df.withColumn("key", F.explode(F.array(*(_cells_hash(group, g) for g, group in enumerate(groups)))))  # noqa: B023, E731
        a, b = keyed(left).withColumnRenamed("cells", "a"), keyed(old).withColumnRenamed("cells", "b").withColumnRenamed("block", "_block")
        met = a.join(b, F.col("block").eqNullSafe(F.col("_block")) & (a["key"] == b["key"]))
        met = met.select(
            "block", "new", "old",
            F.filter(F.array(*(F.when(x, columns[i]) for i, x in enumerate(differ))), lambda x: x.isNotNull()).alias("changed")
        )
        best = met.where(F.size("changed") <= d).groupBy("block", "new").agg(F.min(F.struct(F.size("changed").alias("n"), "old", "changed")).alias("best"))
        found.append(staged(best.select("block", "new", "best.old", "best.changed"), "paired"))
        rest = left.join(
            found[-1].select(F.col("block").alias("_block"), F.col("new").alias("_new")),
            F.col("block").eqNullSafe(F.col("_block")) & (F.col("new") == F.col("_new")), "left_anti"
        )
        left = staged(rest, "left")
        if left.isEmpty():
            break
    if max_changed is None or max_changed >= c:
        first = old.groupBy(F.col("block").alias("_block")).agg(F.min("old").alias("old"))
        far = left.join(first, F.col("block").eqNullSafe(F.col("_block")), "left").select(
            "block", "new", "old", F.when(F.col("old").isNotNull(), F.array(*map(F.lit, columns))).alias("changed")
        )
    else:
        far = left.select("block", "new", F.lit(None).cast(old.schema["old"].dataType).alias("old"), F.lit(None).cast("array<string>").alias("changed"))
    pairs = reduce(DataFrame.unionByName, found, far)
    kinds = new.join(
        pairs.withColumnRenamed("block", "_block").withColumnRenamed("new", "_new"),
        F.col("block").eqNullSafe(F.col("_block")) & (F.col("new") == F.col("_new")), "left"
    )
    kinds = kinds.select(F.col("block").alias("_block"), F.col("cells").alias("_cells"), "old", "changed")
    out = after.join(kinds, F.col("block").eqNullSafe(F.col("_block")) & F.col("cells").eqNullSafe(F.col("_cells")), "left")
    return out.select("block", "row", "cells", "old", "changed")


def _partners(before: DataFrame, after: DataFrame, columns: list[str], max_changed: int | None, with_cells: bool) -> DataFrame:
    """Rows of ``after`` with their partners (block, row, cells, old, old_cells if asked for, changed). Only blocks with more than ``FEW`` rows of ``before`` go by rounds."""
    large = staged(before.groupBy(F.col("block").alias("_block")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FEW).select("_block"), "large")
    given = ["block", "row", "cells", "old", *(["old_cells"] if with_cells else []), "changed"]
    if large.isEmpty():
        return _whole_blocks(before, after, columns, max_changed).select(*given)
    part = lambda df, how: df.join(large, F.col("block") == F.col("_block"), how)
    small = _whole_blocks(part(before, "left_anti"), part(after, "left_anti"), columns, max_changed)
    rest = part(before, "left_semi")
    rounds = _by_rounds(rest, part(after, "left_semi"), columns, max_changed)
    if with_cells:
        cells = rest.select(F.col("block").alias("_block"), F.col("old").alias("_old"), F.col("cells").alias("old_cells"))
        rounds = rounds.join(cells, (F.col("block") == F.col("_block")) & (F.col("old") == F.col("_old")), "left")
    return small.select(*given).unionByName(rounds.select(*given))


def pair_rows(before: DataFrame, after: DataFrame, block: list[str], columns: list[str], order: str, *, max_changed: int | None = None) -> DataFrame:
    """For each row of ``after`` the row of ``before`` in its block that differs in the fewest ``columns`` (null being equal to null), of equals the first.

    Gives ``block``, ``after_<order>``, ``before_<order>``, ``n_changed`` and ``changed`` (column names). ``order`` is unique within a block on each
    side. A row of ``after`` has one partner; one of ``before`` may have several, as a repair may split rows. A block that ``before``
    lacks, and rows that differ in more than ``max_changed`` columns from all others, have a null partner. Null blocks are a block.

    A row of ``after`` meets its whole block only if that has at most ``FEW`` rows of ``before``; larger blocks go by rounds of equi-joins.
    """
    pairs = _partners(_rows(before, block, columns, order, "old"), _rows(after, block, columns, order, "row"), columns, max_changed, False)
    return pairs.select(
        *(F.col("block").getField(x).alias(x) for x in block), F.col("row").alias(f"after_{order}"), F.col("old").alias(f"before_{order}"),
        F.when(F.col("old").isNotNull(), F.size("changed")).alias("n_changed"), "changed"
    )


def row_changes(before: DataFrame, after: DataFrame, block: list[str], columns: list[str], order: str, *, max_changed: int | None = None) -> DataFrame:
    """What a repair did, cell by cell: ``block``, ``state``, the rows' ``order`` on both sides, ``column_name``, ``before`` and ``after`` as text.

    ``state`` is result for cells in which a row differs from its partner, added for all cells of a row without partner, and removed for
    those of a row of ``before`` that is nobody's partner. Rows that didn't change give nothing.
    """
    olds = _rows(before, block, columns, order, "old")
    pairs = staged(_partners(olds, _rows(after, block, columns, order, "row"), columns, max_changed, True), "pairs")
    cells = lambda old, new: F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), old(i).alias("before"), new(i).alias("after")) for i, c in enumerate(columns))))
    text = lambda side: lambda i: F.col(f"{side}.c{i}").cast("string")
    at = [F.col("block").getField(x).alias(x) for x in block]
    state = F.when(F.col("old").isNull(), "added").otherwise("result")
    changed = pairs.where(F.col("old").isNull() | (F.size("changed") > 0)).select(
        *at, state.alias("state"), F.col("old").alias(f"before_{order}"), F.col("row").alias(f"after_{order}"), "changed",
        cells(text("old_cells"), text("cells"))
    )
    changed = changed.where((F.col("state") == "added") | F.array_contains("changed", F.col("column_name"))).drop("changed")
    used = pairs.where("old IS NOT NULL").select(F.col("block").alias("_block"), F.col("old").alias("_old"))
    gone = olds.join(used, (F.col("block") == F.col("_block")) & (F.col("old") == F.col("_old")), "left_anti")
    none = F.lit(None)
    gone = gone.select(
        *at, F.lit("removed").alias("state"), F.col("old").alias(f"before_{order}"),
        none.cast(after.schema[order].dataType).alias(f"after_{order}"),
        cells(text("cells"), lambda i: none.cast("string"))
    )
    return changed.unionByName(gone)
