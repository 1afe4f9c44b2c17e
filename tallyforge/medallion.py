"""The load from landed rows to bronze tables, and the run through all layers.

A load marks rows instead of taking them out: each step notes what it did in a row's list of events and may say that the row is gone. The
marked rows are computed and written once; the kept rows, the checks and the events are all read from there. What was changed on the way is
a table of events, what was found a table of checks.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import functions as T
from . import operators as O
from .plans import models as M
from .rules import RULES
from .sources import LAYERS, Warehouse, close_run, normalised_columns, open_run, with_lineage
from .staging import staged

EVENT = "dataset string, action string, row_key string, column_name string, before string, after string, context string"
CHECK = "dataset string, check string, found long, passed boolean, n_null long, samples string"
_NOTE = "array<struct<action: string, row_key: string, column_name: string, before: string, after: string, context: string>>"
#: Offending rows or keys that a check shows at most.
SAMPLES = 10

@dataclass(frozen=True)
class Reference:
    """Columns whose values the parent's columns must have. A null is no violation; with ``allow_null`` the rows that have one are counted."""

    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]
    allow_null: bool = False


# References of landed datasets (fixed values).
_PERSON, _SEASON, _CHALLENGE = ("castaway_id",), ("version_season",), ("version_season", "challenge_id")
REFERENCES: dict[str, list[Reference]] = {
    "vote_history": [
        *(Reference((c,), "castaway_details", _PERSON, True) for c in ("castaway_id", "vote_id", "voted_out_id")),
        Reference(_CHALLENGE, "challenge_description", _CHALLENGE, True)
    ],
    **{name: [Reference(_PERSON, "castaway_details", _PERSON), Reference(_SEASON, "season_summary", _SEASON)] for name in ("journeys", "castaway_scores")},
}

#: A repair takes marked rows (``_events``, ``_gone``) and the tables loaded before, and gives marked rows.
Repair = Callable[[DataFrame, dict[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class Parents:
    """Rows that a load adds to an earlier table: a stub for each of ``keys`` that ``parent`` lacks, with ``enrich`` from ``summary`` if that table has them."""

    parent: str
    keys: tuple[str, ...]
    order: str
    enrich: tuple[str, ...] = ()
    summary: str | None = None


@dataclass(frozen=True)
class Dataset:
    """How a landed dataset becomes a table.

    ``order`` decides which of several rows of a key stays; rows that agree in it are told apart by their content. ``context`` names the
    columns that events and samples show beside what they are about; ``after`` tables that its repairs look things up in.
    """

    name: str
    schema: str
    keys: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    nullable: tuple[str, ...] = ()
    renames: dict[str, str] = field(default_factory=dict)
    repairs: tuple[Repair, ...] = ()
    parents: tuple[Parents, ...] = ()
    rules: tuple[str, ...] | None = None
    references: tuple[Reference, ...] | None = None
    context: tuple[str, ...] = ()
    after: tuple[str, ...] = ()

    def needs(self) -> set[str]:
        """Tables that have to be loaded before."""
        found = {r.parent for r in (self.references if self.references is not None else REFERENCES.get(self.name, ()))}
        return (found | set(self.after) | {t for p in self.parents for t in (p.parent, p.summary) if t}) - {self.name}


def row_key(keys: list[str] | tuple[str, ...]) -> Column:
    return F.concat_ws("/", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))


def _context(columns: list[str] | tuple[str, ...]) -> Column:
    return F.concat_ws(", ", *(F.concat(F.lit(f"{c}="), F.col(c).cast("string")) for c in columns)) if columns else F.lit(None).cast("string")


def note(
    action: str, keys: list[str] | tuple[str, ...], column: str | None = None, before: Column | None = None, after: Column | None = None,
    context: Column | None = None
) -> Column:
    """An event of a row: what was done (``action``) to which row and column."""
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    return F.struct(
        F.lit(action).alias("action"), row_key(keys).alias("row_key"), F.lit(column).cast("string").alias("column_name"),
        text(before).alias("before"), text(after).alias("after"), text(context).alias("context")
    )


def noted(df: DataFrame, where: Column, event: Column, *, gone: bool = False) -> DataFrame:
    """Marked rows with a further event where a condition holds; with ``gone`` these rows go. Rows that are gone already have no more events."""
    hit = ~F.col("_gone") & F.coalesce(where, F.lit(False))
    df = df.withColumn("_events", F.when(hit, F.concat("_events", F.array(event))).otherwise(F.col("_events")))
    return df.withColumn("_gone", F.col("_gone") | hit) if gone else df


def drop_orphans(keys: list[str], column: str, parent: str, parent_column: str) -> Repair:
    """Rows whose reference is null or has no parent go, with an event each; all stay if the parent is absent or has no rows."""

    def run(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        if parent not in tables:
            return df
        known = tables[parent].select(F.col(parent_column).alias("_known")).dropna().distinct()
        some = F.broadcast(known.agg((F.count(F.lit(1)) > 0).alias("_some")))  # one row
        met = O.left_lookup(df, known, [column], ["_known"]).crossJoin(some)
        return noted(met, F.col("_known").isNull() & F.col("_some"), note("orphan dropped", keys, column, F.col(column)), gone=True).drop("_known", "_some")

    return run


def null_references(keys: list[str], column: str, parent: str, parent_column: str) -> Repair:
    """References without a parent become null, with an event each."""

    def run(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
        known = tables[parent].select(F.col(parent_column).alias("_known")).dropna().distinct()
        met = O.left_lookup(df, known, [column], ["_known"])
        bad = F.col(column).isNotNull() & F.col("_known").isNull()
        return noted(met, bad, note("reference nulled", keys, column, F.col(column))).withColumn(column, F.when(~bad, F.col(column))).drop("_known")

    return run


def report_nulls(keys: list[str], column: str) -> Repair:
    """Rows with a null in ``column`` stay, with an event each."""
    return lambda df, tables: noted(df, F.col(column).isNull(), note("null kept", keys, column))


def _family(kind: str) -> str:
    for family, names in {
        "number": ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal"), "text": ("string", "varchar", "char"),
        "time": ("date", "timestamp"), "boolean": ("boolean",)
    }.items():
        if kind.startswith(names):
            return family
    return kind


def _checked_columns(df: DataFrame, dataset: Dataset) -> list[tuple[str, str]]:
    """Extra columns with their types. Missing ones are an error, and so are types that no lenient cast reads: text and like types can be."""
    schema = StructType.fromDDL(dataset.schema)
    wanted = {f.name: f.dataType.simpleString() for f in schema}
    missing = [c for c, problem in O.schema_differences(df.schema, schema) if problem == "missing"]
    if missing:
        raise ValueError(f"{dataset.name} lacks {', '.join(missing)}")
    wrong = []
    for name, kind in df.dtypes:
        a, b = _family(kind), _family(wanted.get(name, kind))
        if kind != wanted.get(name, kind) and not (
            a == b and a in ("number", "time", "text") or a == "text" and b in ("number", "time", "boolean") or b == "text" and a in ("number", "time", "boolean") or {a, b} == {"number", "boolean"}
        ):
            wrong.append(f"{name} is {kind} instead of {wanted[name]}")
    if wrong:
        raise ValueError(f"{dataset.name}: {', '.join(wrong)}")
    return [(name, kind) for name, kind in df.dtypes if name not in wanted]


def marked(landed: DataFrame, dataset: Dataset, tables: dict[str, DataFrame]) -> DataFrame:
    """The rows after all repairs, with ``_events``, ``_gone`` and, beside each other, what landed and the conformed row (``_row``)."""
    df = normalised_columns(landed, dataset.renames)
    keys, schema = dataset.keys, StructType.fromDDL(dataset.schema)
    names = keys or tuple(df.columns[:1])
    df = df.withColumns({"_events": F.array().cast(_NOTE), "_gone": F.lit(False)})
    for repair in dataset.repairs:
        df = repair(df, tables)
    extras = _checked_columns(df.drop("_events", "_gone"), dataset)
    if keys:
        exempt = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in dataset.nullable), F.lit(False))
        whole = F.to_json(F.struct(*(F.col(f.name) for f in schema)), {"ignoreNullFields": "false"})
        order = [F.col(c).asc_nulls_last() for c in dataset.order]
        df = df.withColumn("_exempt", F.col("_gone") | exempt)
        df = df.withColumn("_spread", F.when(F.col("_exempt"), O.content_hash(df)))  # exempt rows have no place among others, so they needn't meet
        df = df.withColumn("_nth", F.when(~F.col("_exempt"), F.row_number().over(Window.partitionBy(*keys, "_exempt", "_spread").orderBy(*order, whole))))
        df = noted(df, F.col("_nth") > 1, note("duplicate dropped", keys), gone=True).drop("_nth", "_exempt", "_spread")
    conformed = {f.name: O.lenient(F.col(f.name), f.dataType) for f in schema}
    changes = [
        F.when(
            T.changed(F.col(c).cast("string"), v.cast("string")), note("value coerced", names, c, F.col(c), v, _context(dataset.context))
        ) for c,
        v in conformed.items()
    ]
    coerced = F.when(F.col("_gone"), F.array().cast(_NOTE)).otherwise(F.filter(F.array(*changes).cast(_NOTE), lambda e: e.isNotNull()))
    row = F.struct(*(v.alias(c) for c, v in conformed.items()))
    kept = [c for c in df.columns if c not in dict(extras)]
    return staged(
        df.select(
            *(c for c in kept if c not in ("_events", "_gone")), F.concat("_events", coerced).alias("_events"), "_gone", row.alias("_row")
        ),
        dataset.name
    )


def _offenders(df: DataFrame, dataset: Dataset, rules: list[str], tables: dict[str, DataFrame]) -> list[DataFrame]:
    """Rows (check, sample): what each rule, the key and each reference object to."""
    names = dataset.keys or tuple(df.columns[:1])
    beside = F.when(F.lit(bool(dataset.context)), F.concat(F.lit(" ("), _context(dataset.context), F.lit(")"))) if dataset.context else F.lit("")
    sample = F.concat(row_key(names), beside)
    found, missing = [], []
    for rule in rules:
        kind, column, _ = O.rule_parts(rule)
        if column not in df.columns:
            continue
        if kind == "missing":
            missing.append(F.when(F.col(column).isNull(), F.struct(F.lit(rule).alias("check"), sample.alias("sample"))))
        else:
            found.append(
                df.groupBy(F.col(column).cast("string").alias("sample")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(
                    F.lit(rule).alias("check"), F.coalesce("sample", F.lit("")).alias("sample")
                )
            )
    if missing:
        found.append(df.select(F.explode(F.array(*missing)).alias("bad")).where("bad IS NOT NULL").select("bad.*"))
    if dataset.keys:
        bad = O.duplicates_of_key(df, list(dataset.keys), list(dataset.nullable))
        found.append(bad.select(F.lit(_unique(dataset)).alias("check"), F.concat(row_key(dataset.keys), F.lit(" "), F.col("problem")).alias("sample")))
    for r in _references(dataset):
        if r.parent in tables and set(r.columns) <= set(df.columns):
            bad = O.foreign_key_violations(df, list(r.columns), tables[r.parent], list(r.parent_columns))
            found.append(bad.select(F.lit(_check(r)).alias("check"), row_key(r.columns).alias("sample")))
    return found


def _references(dataset: Dataset) -> tuple[Reference, ...]:
    return tuple(dataset.references if dataset.references is not None else REFERENCES.get(dataset.name, ()))


def _unique(dataset: Dataset) -> str:
    return f"unique({', '.join(dataset.keys)})"


def _check(r: Reference) -> str:
    return f"{', '.join(r.columns)} in {r.parent}"


def validate(df: DataFrame, dataset: Dataset, tables: dict[str, DataFrame]) -> DataFrame:
    """Rows of CHECK: rules, the key, references.

    A reference whose parent is absent or empty, or whose columns the rows lack, is skipped: ``found`` is null and it passes. ``n_null`` counts the nulls of a reference that
    allows them. ``samples`` are the least SAMPLES of what a failed check objects to, kept by each task before they meet.
    """
    rules = list(dataset.rules if dataset.rules is not None else RULES.get(dataset.name, ()))
    none = F.lit(None).cast("long")
    parts = [O.run_rules(df, rules).select(F.col("rule").alias("check"), "found", "passed", none.alias("n_null"))] if rules else []
    if dataset.keys:
        bad = O.duplicates_of_key(df, list(dataset.keys), list(dataset.nullable)).agg(F.count(F.lit(1)).alias("found"))
        parts.append(bad.select(F.lit(_unique(dataset)).alias("check"), "found", (F.col("found") == 0).alias("passed"), none.alias("n_null")))
    for r in _references(dataset):
        check = F.lit(_check(r)).alias("check")
        if r.parent not in tables or not set(r.columns) <= set(df.columns):
            parts.append(df.sparkSession.range(1).select(check, none.alias("found"), F.lit(True).alias("passed"), none.alias("n_null")))
            continue
        bad = O.foreign_key_violations(df, list(r.columns), tables[r.parent], list(r.parent_columns)).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("bad"))
        nulls = df.agg(F.count_if(reduce(lambda a, b: a | b, (F.col(c).isNull() for c in r.columns))).alias("nulls"))
        row = bad.crossJoin(nulls).crossJoin(tables[r.parent].agg((F.count(F.lit(1)) > 0).alias("some")))  # one row each
        row = row.select(check, F.when(F.col("some"), F.col("bad")).alias("found"), F.when(F.col("some") & F.lit(r.allow_null), F.col("nulls")).alias("n_null"))
        parts.append(row.select("check", "found", F.coalesce(F.col("found") == 0, F.lit(True)).alias("passed"), "n_null"))
    if not parts:
        return df.sparkSession.createDataFrame([], CHECK)
    checks = reduce(DataFrame.unionByName, parts)
    offenders = _offenders(df, dataset, rules, tables)
    if not offenders:
        shown = df.sparkSession.createDataFrame([], "check string, samples string")
    else:
        first = F.row_number().over(Window.partitionBy("check").orderBy("sample"))
        few = reduce(DataFrame.unionByName, offenders).withColumn("nth", first).where(F.col("nth") <= SAMPLES)
        shown = few.groupBy("check").agg(F.array_join(F.array_sort(F.collect_set("sample")), "; ").alias("samples"))
    out = checks.join(F.broadcast(shown), "check", "left")  # a row for each check
    return out.select(
        F.lit(dataset.name).alias("dataset"), "check", F.col("found").cast("long").alias("found"), "passed",
        F.col("n_null").cast("long").alias("n_null"), F.when(~F.col("passed"), F.col("samples")).alias("samples")
    )


def prepared(landed: DataFrame, dataset: Dataset, tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Conformed rows, checks (CHECK) and events (EVENT) of a landed dataset.

    A column of the schema that is missing, or of a type that can't be read as the schema's, is an error; further columns go, with an event each.
    """
    extras = _extras(landed, dataset)
    rows = marked(landed, dataset, tables)
    kept = rows.where("NOT _gone")
    events = rows.select(F.lit(dataset.name).alias("dataset"), F.inline("_events"))
    if extras:
        said = F.array(
            *(
                F.struct(
                    F.lit("column dropped").alias("action"), F.lit(None).cast("string").alias("row_key"), F.lit(c).alias("column_name"),
                    F.lit(kind).alias("before"), F.lit(None).cast("string").alias("after"), F.lit(None).cast("string").alias("context")
                ) for c,
                kind in extras
            )
        )
        events = events.unionByName(rows.sparkSession.range(1).select(F.lit(dataset.name).alias("dataset"), F.inline(said)))
    return kept.select("_row.*"), validate(kept.drop("_events", "_gone", "_row"), dataset, tables), events


def _extras(landed: DataFrame, dataset: Dataset) -> list[tuple[str, str]]:
    """Landed columns that the schema lacks."""
    wanted = set(StructType.fromDDL(dataset.schema).names)
    return [x for x in normalised_columns(landed, dataset.renames).dtypes if x[0] not in wanted]


def add_parents(warehouse: Warehouse, rows: DataFrame, dataset: Dataset, run_id: str, at: str) -> DataFrame:
    """Adds the parents that ``rows`` lack to their tables, and gives an event for each."""
    events = rows.sparkSession.createDataFrame([], EVENT)
    for p in dataset.parents:
        parent = warehouse.load(f"bronze.{p.parent}")
        summary = warehouse.load(f"bronze.{p.summary}") if p.summary else None
        stubs = staged(O.create_missing_parents(rows, parent, list(p.keys), p.order, list(p.enrich), summary), "parents")
        lineage = with_lineage(stubs, run_id, dataset.name, at)
        full = lineage.select(*((F.col(f.name) if f.name in lineage.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in parent.schema))
        warehouse.write(full, "bronze", p.parent, "upsert", list(p.keys))
        said = stubs.select(
            F.lit(p.parent).alias("dataset"), F.lit("parent added").alias("action"), row_key(p.keys).alias("row_key"),
            *(F.lit(None).cast("string").alias(c) for c in ("column_name", "before", "after")), F.lit(f"by {dataset.name}").alias("context")
        )
        events = events.unionByName(said)
    return events


def load_order(datasets: list[Dataset]) -> list[Dataset]:
    """The datasets with each after those it needs; otherwise in their own order. A circle of needs is an error."""
    left, out = list(datasets), []
    while left:
        names = {d.name for d in left}
        ready = [d for d in left if not d.needs() & names]
        if not ready:
            raise ValueError(f"{', '.join(sorted(names))} need each other")
        out.append(ready[0])
        left.remove(ready[0])
    return out


def load_bronze(
    warehouse: Warehouse, landed: DataFrame, dataset: Dataset, run_id: str, at: str, *, strict: bool = True, environment: str = "dev",
    mode: str = "upsert"
) -> DataFrame:
    """Loads a dataset into its bronze table and gives its rows. ``mode`` is upsert (on its keys, else append) or refresh, which in environment "prod" never empties a table: it upserts there.

    Missing parents are added to their tables first. Checks and events are appended to bronze.validation_checks and bronze.remediation_events; with
    ``strict`` a failed check raises then.
    """
    if mode not in ("upsert", "refresh"):
        raise ValueError(f"mode {mode} isn't upsert or refresh")
    tables = {t: warehouse.load(f"bronze.{t}") for _, t in warehouse.list_tables("bronze")}
    rows, checks, events = prepared(landed, dataset, tables)
    if dataset.parents:
        events = events.unionByName(add_parents(warehouse, rows, dataset, run_id, at))
        tables = {t: warehouse.load(f"bronze.{t}") for t in tables}
        checks = validate(rows, dataset, tables)
    for found, name in ((checks, "validation_checks"), (events, "remediation_events")):
        warehouse.write(found.withColumn("run_id", F.lit(run_id)), "bronze", name, "append")
    failed = warehouse.load("bronze.validation_checks").where((F.col("run_id") == run_id) & (F.col("dataset") == dataset.name) & ~F.col("passed"))
    if strict and (bad := [r.check for r in failed.select("check").collect()]):  # a row for each rule at most
        raise ValueError(f"{dataset.name} fails {'; '.join(bad)}")
    how = "overwrite" if mode == "refresh" and environment != "prod" else "upsert"  # which appends where there are no keys
    warehouse.write(with_lineage(rows, run_id, dataset.name, at), "bronze", dataset.name, how, list(dataset.keys))
    return warehouse.load(f"bronze.{dataset.name}")


def run_pipeline(
    warehouse: Warehouse, landed: dict[str, tuple[DataFrame, str]], datasets: list[Dataset], at: str, *, environment: str = "dev",
    upto: str = "gold", only_if_changed: bool = True, strict: bool = True
) -> str:
    """Bronze, silver and gold up to a layer: "succeeded", or "unchanged" if no signature of ``landed`` (rows and signature by name) is new.

    Datasets load after those they refer to, and with ``only_if_changed`` only those whose signature is new; of the silver models only those
    that read one of them, or have no table yet, are made anew. Each model is written once and read by those above it. Signatures are recorded when all is done.
    """
    if upto not in LAYERS:
        raise ValueError(f"{upto} isn't one of {', '.join(LAYERS)}")
    spark = warehouse.spark
    versions = spark.createDataFrame([(name, signature) for name, (_, signature) in landed.items()], "dataset string, signature string")
    news = set(landed)
    if only_if_changed and ("bronze", "dataset_versions") in warehouse.list_tables():
        status = O.source_changes(versions, warehouse.load("bronze.dataset_versions"), "dataset", ["signature"])
        news = {r.dataset for r in status.where("status IN ('new', 'changed')").collect()}  # a row for each dataset at most
        if not news:
            return "unchanged"
    run_id = open_run(warehouse, environment, at)
    try:
        touched = set()
        for dataset in load_order([d for d in datasets if d.name in news]):
            load_bronze(warehouse, landed[dataset.name][0], dataset, run_id, at, strict=strict, environment=environment)
            touched |= {dataset.name, *(p.parent for p in dataset.parents)}
        if upto != "bronze":
            there = {t for _, t in warehouse.list_tables("silver")}
            for model, names in M.SILVER.items():
                if model.__name__ not in there or touched & set(names):
                    warehouse.write(model(*(warehouse.load(f"bronze.{n}") for n in names)), "silver", model.__name__)
        if upto == "gold":
            silver = {t: warehouse.load(f"silver.{t}") for _, t in warehouse.list_tables("silver")}
            warehouse.write(M.ml_features_non_edit(warehouse.load("bronze.castaways"), silver), "gold", "ml_features_non_edit")
            warehouse.write(M.ml_features_hybrid(warehouse.load("gold.ml_features_non_edit"), silver["edit_features"]), "gold", "ml_features_hybrid")
    except Exception:
        close_run(warehouse, run_id, "failed", at)
        raise
    warehouse.write(versions, "bronze", "dataset_versions", "upsert", ["dataset"])
    close_run(warehouse, run_id, "succeeded", at)
    return "succeeded"
