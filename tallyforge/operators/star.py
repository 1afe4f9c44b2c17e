"""A star schema: dimensions kept by upsert under stable keys, bridges, and facts that look the keys up."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import surrogate_key
from .repair import left_lookup, upsert


@dataclass(frozen=True)
class Dimension:
    """``key`` is a digest of the ``natural`` columns, so it is the same in every run and on every machine, without a counter.

    ``columns`` are further columns and the expressions they come from; ``text_key`` is an expression where the key is to be readable.
    ``few``: its rows stay few however many facts there are (seasons, episodes), so facts don't travel to them.
    """

    name: str
    key: str
    natural: tuple[str, ...]
    columns: dict[str, str] = field(default_factory=dict)
    text_key: str | None = None
    few: bool = False

    def key_of(self, *natural: Column) -> Column:
        return surrogate_key(*natural)


@dataclass(frozen=True)
class Lookup:
    """A fact's way to a dimension: ``columns`` of the fact hold its natural key. ``required`` facts go where the dimension lacks it; else the key is null."""

    dimension: str
    columns: tuple[str, ...]
    alias: str
    required: bool = False


def dimension_rows(source: DataFrame, d: Dimension) -> DataFrame:
    """The dimension's rows from its source: one for each natural key, of several the least by content; rows with a null in the natural key go."""
    key = F.expr(d.text_key) if d.text_key else d.key_of(*map(F.col, d.natural))
    rows = source.dropna(subset=list(d.natural)).select(key.alias(d.key), *d.natural, *(F.expr(e).alias(c) for c, e in d.columns.items()))
    rest = [c for c in rows.columns if c != d.key]
    return rows.groupBy(d.key).agg(F.min(F.struct(*rest)).alias("row")).select(d.key, "row.*")


def keep_dimension(held: DataFrame | None, rows: DataFrame, d: Dimension) -> DataFrame:
    """``held`` after an upsert of ``rows``; ``is_late`` is false for what a source has described. Keys never change."""
    rows = rows.withColumn("is_late", F.lit(False))
    return rows if held is None else upsert(held, rows, [d.key])


def with_late_members(held: DataFrame, facts: DataFrame, d: Dimension, columns: tuple[str, ...]) -> DataFrame:
    """``held`` and a row, ``is_late`` with nulls, for each natural key that ``facts`` have and it lacks: facts find a key now, and the dimension's source fills the row in later."""
    known = facts.select(*(F.col(c).alias(n) for c, n in zip(columns, d.natural))).dropna().distinct()
    missing = known.join(held.select(*d.natural), list(d.natural), "left_anti")
    key = F.expr(d.text_key) if d.text_key else d.key_of(*map(F.col, d.natural))
    rows = missing.select(key.alias(d.key), *d.natural)
    rest = [f for f in held.schema if f.name not in rows.columns and f.name != "is_late"]
    return held.unionByName(rows.select("*", *(F.lit(None).cast(f.dataType).alias(f.name) for f in rest), F.lit(True).alias("is_late")))


def fact_rows(source: DataFrame, lookups: list[Lookup], dimensions: dict[str, tuple[Dimension, DataFrame]], columns: dict[str, str]) -> DataFrame:
    """The fact's rows: the keys of its lookups, then ``columns`` (name and expression). Only a dimension's key columns are joined. Dimensions of few
    rows are broadcast, and first: shuffled, all facts of a season would meet in one task. Facts without a natural key are dealt to all tasks."""
    out = source
    for n, lookup in sorted(enumerate(lookups), key=lambda x: not dimensions[x[1].dimension][0].few):
        d, rows = dimensions[lookup.dimension]
        keys = rows.select(F.col(d.key).alias(f"_key{n}"), *(F.col(c).alias(f"_{n}_{c}") for c in d.natural))
        named = [f"_{n}_{c}" for c in d.natural]
        match = [F.col(c) == F.col(k) for c, k in zip(lookup.columns, named)]
        if d.few:
            out = out.join(F.broadcast(keys), match, "inner" if lookup.required else "left")
        else:
            out = out.join(keys, match) if lookup.required else left_lookup(out, keys, list(lookup.columns), named)
    return out.select(*(F.col(f"_key{n}").alias(x.alias) for n, x in enumerate(lookups)), *(F.expr(e).alias(c) for c, e in columns.items()))


def flag_bridge(source: DataFrame, key: Column, name: str, flags: list[str], flag: str) -> DataFrame:
    """Distinct (key, flag name) where a flag is set, a row's flags unfolded in place."""
    held = F.filter(F.array(*(F.when(F.col(f), F.lit(f)) for f in flags)), lambda x: x.isNotNull())
    return source.select(key.alias(name), F.explode(held).alias(flag)).distinct()
