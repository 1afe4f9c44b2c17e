"""Repairs: multi-valued cells, duplicates, types, references, missing parents, upserts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType, StructType, TimestampType

from .. import functions as T
from ..staging import staged


def explode_multi_value(df: DataFrame, ids: str, names: str, *, flag: str = "joint", companions: str = "companions") -> DataFrame:
    """A row for each id of a multi-valued cell, with the name at its place (names are padded with the last or cut).

    Adds ``flag`` (the cell had several ids) and ``companions`` (the other ids as text). A cell without ids stays as one row with null.
    """
    items = T.split_cell(F.col(ids).cast("string"))
    out = df.withColumn("_ids", F.when(F.size(items) > 0, items).otherwise(F.array(F.lit(None).cast("string"))))
    out = out.withColumn("_names", T.align_cells(F.coalesce(T.split_cell(F.col(names)), F.array().cast("array<string>")), F.size("_ids")))
    out = out.select("*", F.inline(F.arrays_zip(F.col("_ids").alias("_id"), F.col("_names").alias("_name"))).alias("_id", "_name"))
    out = out.withColumn(flag, F.size("_ids") > 1).withColumn(companions, T.join_cell(T.others(F.col("_ids"), F.col("_id"))))
    return out.withColumn(ids, F.col("_id")).withColumn(names, F.col("_name")).drop("_ids", "_names", "_id", "_name")


def explode_targets(df: DataFrame, ids: str, names: str, *, companions: str = "companions", flag: str = "multi_target") -> DataFrame:
    """``explode_multi_value`` for targets: their other members join the companions that the row has already."""
    out = explode_multi_value(df.withColumnRenamed(companions, "_had"), ids, names, flag=flag, companions="_more")
    both = F.concat(
        F.coalesce(T.split_cell(F.col("_had")), F.array().cast("array<string>")),
        F.coalesce(T.split_cell(F.col("_more")), F.array().cast("array<string>"))
    )
    return out.withColumn(companions, T.join_cell(both)).drop("_had", "_more")


def left_lookup(df: DataFrame, found: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Left join of ``df`` with ``found`` where its ``columns`` equal ``keys``. Rows with a null in one match nothing: they are dealt to all tasks by their content, not to one."""
    match = [F.col(c) == F.col(k) for c, k in zip(columns, keys)]
    kinds, theirs = dict(df.dtypes), dict(found.dtypes)
    if any(kinds[c] != theirs[k] for c, k in zip(columns, keys)):
        return df.join(found, match, "left")  # values of unlike types are equal while their hashes differ
    lacks = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in columns))
    spread = F.when(lacks, content_hash(df)).otherwise(F.xxhash64(*columns))
    a, b = df.withColumn("_spread", spread), found.withColumn("_at", F.xxhash64(*keys))
    return a.join(b, [*match, F.col("_spread") == F.col("_at")], "left").drop("_spread", "_at")


def content_hash(df: DataFrame) -> Column:
    """A hash of a row's plain columns; nested ones are left out."""
    return F.xxhash64(*(F.col(c) for c, kind in df.dtypes if "<" not in kind))


def null_invalid(df: DataFrame, column: str, valid: DataFrame, valid_column: str) -> tuple[DataFrame, DataFrame]:
    """Nulls references that don't resolve; the rows that had one are the second result."""
    known = valid.select(F.col(valid_column).alias("_known")).dropna().distinct()
    joined = left_lookup(df, known, [column], ["_known"])
    return joined.withColumn(
        column, F.when(F.col("_known").isNotNull(), F.col(column))
    ).drop("_known"), joined.where(F.col(column).isNotNull() & F.col("_known").isNull()).drop("_known")


def dedupe_keep_first(df: DataFrame, keys: list[str], *order: str) -> tuple[DataFrame, DataFrame]:
    """The first row of each key by ``order``, and the others. Nulls in a key are equal."""
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*(F.col(c).asc_nulls_last() for c in order)))
    ranked = df.withColumn("_nth", nth)
    return ranked.where("_nth = 1").drop("_nth"), ranked.where("_nth > 1").drop("_nth")


def flag_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Adds ``is_duplicate``: whether other rows have the same key."""
    return df.withColumn("is_duplicate", F.count(F.lit(1)).over(Window.partitionBy(*keys)) > 1)


def lenient(column: Column, kind: DataType) -> Column:
    """The column read as a type, null where it can't be."""
    for kinds, cast in (
        ((BooleanType,), T.lenient_boolean), ((ShortType, IntegerType), T.lenient_integer),
        ((LongType,), lambda c: T.lenient_double(c).try_cast("long")), ((DoubleType, FloatType), T.lenient_double),
        ((DateType,), T.lenient_date), ((TimestampType,), T.lenient_timestamp), ((StringType,), T.clean_id)
    ):
        if isinstance(kind, kinds):
            return cast(column)
    return column.try_cast(kind)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns in its order, cast leniently: what can't be read is null. Further columns go, missing ones are null."""
    return df.select(*((lenient(F.col(f.name), f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields))


def upsert(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``target`` whose key isn't in ``updates``, and all of ``updates``. A null in a key matches nothing; keys of ``updates`` must be unique."""
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates)


def upsert_counts(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """One row: ``n_inserted`` and ``n_updated`` of an upsert."""
    known = target.select(*keys).distinct().withColumn("_known", F.lit(1))
    return updates.join(known, keys, "left").agg(
        F.count_if(F.col("_known").isNull()).alias("n_inserted"), F.count_if(F.col("_known").isNotNull()).alias("n_updated")
    )


def upsert_keys(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` of ``updates`` and ``action``: inserted, or updated where ``target`` has the key."""
    known = target.select(*keys).distinct().withColumn("_known", F.lit(1))
    return updates.select(*keys).join(known, keys, "left").select(*keys, F.when(F.col("_known").isNull(), "inserted").otherwise("updated").alias("action"))


def create_missing_parents(
    children: DataFrame, parents: DataFrame, keys: list[str], order: str, enrich: list[str], summary: DataFrame | None = None
) -> DataFrame:
    """A stub for each key that children have and parents lack: ``enrich`` from ``summary`` if it has them, else the children's first known value by ``order``."""
    missing = children.dropna(subset=keys).join(parents.select(*keys), keys, "left_anti")
    if not enrich:
        return missing.select(*keys).distinct()
    first = [F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in enrich]
    stubs = missing.groupBy(*keys).agg(*first)
    if summary is None:
        return stubs
    known = summary.select(*keys, *(F.col(c).alias(f"_{c}") for c in enrich)).dropDuplicates(keys)
    return stubs.join(known, keys, "left").select(*keys, *(F.coalesce(f"_{c}", c).alias(c) for c in enrich))


def repair_reference(df: DataFrame, column: str, block: list[str], valid: DataFrame, fixes: DataFrame | None = None) -> DataFrame:
    """References that ``valid`` (block, column) lacks: replaced by ``fixes`` (block, column, fixed) or else by the block's only candidate, if it has one.

    Adds ``repaired``: kept, fixed, candidate or unresolved (left as it was).
    """
    known = valid.select(*block, column).dropna().distinct()
    only = known.groupBy(*block).agg(F.min(column).alias("_only"), F.count(F.lit(1)).alias("_n")).where("_n = 1").drop("_n")
    out = df.join(known.withColumn("_known", F.lit(1)), [*block, column], "left").join(only, block, "left")
    if fixes is not None:
        out = out.join(F.broadcast(fixes.withColumnRenamed("fixed", "_fixed")), [*block, column], "left")  # a hand-written list
    else:
        out = out.withColumn("_fixed", F.lit(None).cast(df.schema[column].dataType))
    how = F.when(F.col("_known").isNotNull(), "kept").when(F.col("_fixed").isNotNull(), "fixed").when(F.col("_only").isNotNull(), "candidate").otherwise("unresolved")
    value = F.when(how == "fixed", F.col("_fixed")).when(how == "candidate", F.col("_only")).otherwise(F.col(column))
    return out.withColumn("repaired", how).withColumn(column, value).select(*df.columns, "repaired")


def unpivot_flags(df: DataFrame, ids: list[str], flags: list[str], name: str = "flag") -> DataFrame:
    """Distinct (ids, flag name) where the flag is true."""
    return df.select(*ids, *flags).unpivot(ids, flags, name, "_on").where("_on").drop("_on").distinct()


#: Names of more letters skip the rounds of ``most_similar``; rounds it makes at most; parts that a block's remaining names are dealt to.
SHORT_NAME, NAME_ROUNDS, NAME_PARTS = 40, 2, 32


def most_similar(df: DataFrame, names: DataFrame, block: list[str], name: str, other: str, *, cutoff: float = 0.7) -> DataFrame:
    """``df`` (distinct ``block`` and ``name``) with the row of ``names`` (distinct ``block`` and ``other``) that is most similar, from ``cutoff`` on; of equals the greatest name.

    Two names whose letters don't match in d places (counted on both sides) become equal when i letters go from one and d - i from the other. Round d is thus an
    equi-join of names with d letters gone together (and d - 1, as d is odd or even with the letters), and finds all pairs that near. What it hasn't found has a similarity of 2n / (2n + d + 1) at most, n
    being the name's letters, so a name with a better match leaves. Only names like none in two rounds, or long ones, meet those of their block whose lengths and letters allow the similarity.
    """
    left = staged(df.select(*block, name).dropna(), "names")
    names = staged(names.dropna(subset=[*block, other]), "known")
    rest = [c for c in names.columns if c not in (*block, other)]
    score = T.name_similarity(F.col(name), F.col(other)).alias("_score")
    best = F.max(F.struct("_score", other, *rest)).alias("_best")
    found = []
    for d in range(NAME_ROUNDS + 1):
        if left.isEmpty():
            break
        some = left.where(F.length(name) <= SHORT_NAME)
        met = None
        for i, j in ((i, e - i) for e in (d - 1, d) for i in range(e + 1)):
            a = some.select(*block, name, F.explode(T.letters_gone(F.col(name), i)).alias("_key"))
            b = names.where(F.length(other) <= SHORT_NAME + d).select(*block, other, *rest, F.explode(T.letters_gone(F.col(other), j)).alias("_key"))
            pairs = a.join(b, [*block, "_key"]).drop("_key")
            met = pairs if met is None else met.unionByName(pairs)
        near = met.distinct().select("*", score).where(F.col("_score") >= cutoff).groupBy(*block, name).agg(best)
        n = 2 * F.length(name)
        found.append(staged(near.where(F.col("_best._score") > n / (n + d + 1)), "similar"))
        left = staged(left.join(found[-1].select(*block, name), [*block, name], "left_anti"), "names")
    a, b = F.length(name), F.length(other)
    dealt = left.withColumn("_part", F.pmod(F.xxhash64(name), F.lit(NAME_PARTS)))
    known = names.withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(NAME_PARTS - 1).cast("long"))))
    pairs = dealt.join(known, [*block, "_part"]).where(2 * F.least(a, b) >= cutoff * (a + b))
    pairs = pairs.where(2 * T.letters_in_common(F.col(name), F.col(other)) >= cutoff * (a + b))
    found.append(pairs.select(*block, name, other, *rest, score).where(F.col("_score") >= cutoff).groupBy(*block, name).agg(best))
    return reduce(DataFrame.unionByName, found).select(*block, name, "_best.*")


def resolve_ids(df: DataFrame, people: DataFrame, block: list[str], name: str, id: str, *, cutoff: float = 0.7) -> DataFrame:
    """``df`` with ``id`` and ``resolved_by``, found by ``name`` among ``people`` (block, name, id) of the same block.

    In turn: the exact name, the name without accents, case and signs, a first word or its plain form that only one person has, and the
    most similar name from ``cutoff`` on (of equals the greatest name, then the greatest id). ``most_similar`` finds that for the distinct names left over.
    """
    rows = df.withColumn("_own_plain", T.normalised_name(F.col(name)))
    known = people.select(*block, F.col(name).alias("_name"), F.col(id).alias("_id")).dropna(subset=["_name", "_id"]).distinct()
    known = known.withColumn("_plain_name", T.normalised_name(F.col("_name"))).withColumn("_first", T.first_token(F.col("_name")))
    known = known.withColumn("_plain_first", T.normalised_name(F.col("_first")))

    def lookup(key: str, out: str) -> DataFrame:
        found = known.where(F.col(key).isNotNull() & (F.col(key) != "")).groupBy(*block, F.col(key).alias(f"_{out}_key")).agg(
            F.min("_id").alias(f"_{out}"), F.count_distinct("_id").alias("_n")
        )
        return found.where("_n = 1").drop("_n")

    steps = {
        "exact": ("_name", F.col(name)), "plain": ("_plain_name", F.col("_own_plain")), "first": ("_first", F.col(name)),
        "plain_first": ("_plain_first", F.col("_own_plain"))
    }
    for step, (key, value) in steps.items():
        rows = rows.withColumn(f"_{step}_key", value).join(lookup(key, step), [*block, f"_{step}_key"], "left")
    found = F.coalesce(*(f"_{step}" for step in steps))
    by = F.coalesce(*(F.when(F.col(f"_{step}").isNotNull(), step) for step in steps))
    rows = rows.withColumn("_found", found).withColumn("_by", by)
    left = rows.where(F.col("_found").isNull() & F.col(name).isNotNull()).select(*block, name).distinct()
    names = known.groupBy(*block, "_name").agg(F.max("_id").alias("_id"))
    close = most_similar(left, names, block, name, "_name", cutoff=cutoff).select(*block, name, F.col("_id").alias("_similar"))
    out = rows.join(close, [*block, name], "left").withColumn("_close", F.when(F.col("_found").isNull(), F.col("_similar")))
    return out.select(
        *df.columns, F.coalesce("_found", "_close").alias(id),
        F.coalesce("_by", F.when(F.col("_close").isNotNull(), "similar")).alias("resolved_by")
    )
