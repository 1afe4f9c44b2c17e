"""Data-quality reports as one long table (dataset, section, item, metric, value), and the coverage of datasets."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as T
from .quality import value_counts


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (a, b, correlation) for all pairs of columns, each column with itself too, from one aggregate over the rows."""
    cells = [(a, b, T.correlation(F.col(a).cast("double"), F.col(b).cast("double"))) for a, b in combinations(columns, 2)]
    cells = [x for a, b, v in cells for x in ((a, b, v), (b, a, v))] + [
        (c, c, T.correlation(F.col(c).cast("double"), F.col(c).cast("double"))) for c in columns
    ]
    return df.agg(
        F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), v.alias("correlation")) for a, b, v in cells)).alias("all")
    ).select(F.inline("all"))


def dataset_coverage(loaded: DataFrame, configured: DataFrame, upstream: DataFrame, name: str = "dataset") -> DataFrame:
    """A row for each dataset that any of three lists names: ``status`` and which lists have it, by one merge of all three.

    Loaded (not found upstream), loaded, configured but not loaded, or not configured. Nulls don't count.
    """
    lists = [
        df.select(
            F.col(name).alias("dataset"), *(F.lit(k == i).alias(c) for k, c in enumerate(("is_loaded", "is_configured", "is_upstream")))
        ) for i,
        df in enumerate((loaded, configured, upstream))
    ]
    merged = reduce(DataFrame.unionByName, lists).dropna(subset=["dataset"]).groupBy("dataset").agg(
        *(F.bool_or(c).alias(c) for c in ("is_loaded", "is_configured", "is_upstream"))
    )
    status = F.when(
        F.col("is_loaded") & ~F.col("is_upstream"), "Loaded (not found upstream)"
    ).when(F.col("is_loaded"), "Loaded").when(F.col("is_configured"), "Configured but not loaded").otherwise("Not configured")
    return merged.select("dataset", status.alias("status"), "is_loaded", "is_configured", "is_upstream")


def _rows(df: DataFrame, dataset: str, section: str, item: Column, **metrics: Column) -> DataFrame:
    """A row for each metric that isn't null."""
    cells = F.array(*(F.struct(F.lit(m).alias("metric"), v.cast("string").alias("value")) for m, v in metrics.items()))
    return df.select(
        F.lit(dataset).alias("dataset"), F.lit(section).alias("section"), item.cast("string").alias("item"), F.inline(cells)
    ).where("value IS NOT NULL")


#: What an event's line says, by action; {n} is the number of events (fixed wording).
LINES = {
    "orphan dropped": "Removed {n} rows without a parent", "duplicate dropped": "Removed {n} rows of a key that another row has",
    "reference nulled": "Affected {n} references",
    "null kept": "Affected {n} rows with a null", "value coerced": "Column coerced in {n} rows", "column dropped": "Dropped {n} columns",
    "parent added": "Added {n} rows",
}


def issue_lines(events: DataFrame) -> DataFrame:
    """A row for each dataset and action of an event table: how many, which columns, and a line that says so."""
    per = events.groupBy("dataset", "action").agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("column_name")), ", ").alias("columns"))
    line = F.coalesce(
        *(F.when(F.col("action") == a, F.replace(F.lit(t), F.lit("{n}"), F.col("n").cast("string"))) for a, t in LINES.items()),
        F.concat(F.initcap("action"), F.lit(": "), F.col("n").cast("string"))
    )
    return per.withColumn("line", F.concat_ws("; ", line, F.when(F.col("columns") != "", F.concat(F.lit("columns: "), F.col("columns")))))


def dataset_report(
    dataset: str, rows: DataFrame, landed_types: list[tuple[str, str]], checks: DataFrame, events: DataFrame, *, season: str | None = None,
    baseline: DataFrame | None = None
) -> DataFrame:
    """The report of one dataset, in sections.

    ``rows`` are conformed rows, ``landed_types`` the names and types that landed, ``checks`` and ``events`` what the load gave. Values of all columns are
    counted in one pass over ``rows``; nulls, distinct values and the seasons' coverage come from these counts. Sections: Summary, Column Types,
    Rule Checks, Unique Constraint, Foreign Key Checks, Samples, Null Value Summary, Distinct Values, Season Coverage, Remediation Events, Issues, Unexpected Columns,
    and Notes where nothing was found.
    """
    spark = rows.sparkSession
    section = lambda df, name, item, **metrics: _rows(df, dataset, name, item, **metrics)
    counts = value_counts(rows)
    check, none = F.col("check"), F.lit(None)
    kind = F.when(check.like("unique(%"), "Unique Constraint").when(check.rlike(r"_count\("), "Rule Checks").otherwise("Foreign Key Checks")
    of_kind = lambda k: checks.where(kind == k)
    total = checks.agg(F.count(F.lit(1)).alias("n"), F.count_if(~F.col("passed")).alias("failed")).crossJoin(rows.agg(F.count(F.lit(1)).alias("rows")))  # one row each
    types = spark.createDataFrame(
        [(c, dict(landed_types).get(c), dict(rows.dtypes).get(c)) for c in sorted({*dict(landed_types), *rows.columns})],
        "column string, landed string, stored string"
    )
    values = counts.groupBy("column_name").agg(F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("nulls"), F.count("value").alias("kinds"))
    parts = [
        section(
            total, "Summary", F.lit(dataset), status=F.when(F.col("failed") > 0, "failed").otherwise("passed"), checks_run=F.col("n"),
            checks_failed=F.col("failed"), row_count=F.col("rows")
        ),
        section(types, "Column Types", F.col("column"), landed_type=F.col("landed"), stored_type=F.col("stored")),
        *(
            section(
                of_kind(k), k, check, found=F.col("found"),
                status=F.when(F.col("found").isNull(), "skipped").when(F.col("passed"), "passed").otherwise("failed"),
                n_null=F.col("n_null")
            ) for k in ("Rule Checks", "Unique Constraint", "Foreign Key Checks")
        ),
        section(checks, "Samples", check, samples=F.col("samples")),
        section(values.where("nulls > 0"), "Null Value Summary", F.col("column_name"), null_count=F.col("nulls")),
        section(values, "Distinct Values", F.col("column_name"), n_distinct=F.col("kinds")),
        section(
            events.groupBy("action", "column_name").agg(F.count(F.lit(1)).alias("n")), "Remediation Events", F.col("action"),
            **{"events": F.col("n"), "column": F.col("column_name")}
        ).groupBy("dataset", "section", "item", "metric").agg(F.array_join(F.array_sort(F.collect_list("value")), ", ").alias("value")),
        section(issue_lines(events), "Issues", F.col("action"), impact=F.col("line")),
        section(types.where("stored IS NULL"), "Unexpected Columns", F.col("column"), landed_type=F.col("landed")),
    ]
    if season and baseline is not None:
        here = counts.where((F.col("column_name") == season) & F.col("value").isNotNull()).select(F.col("value").alias("season"), F.lit(1).alias("here"))
        both = here.join(baseline.select(F.col(season).cast("string").alias("season"), F.lit(1).alias("known")).dropna().distinct(), "season", "full")
        names = lambda c: F.array_join(F.array_sort(F.collect_list(F.when(c, F.col("season")))), ", ")
        present, missing, odd = F.col("here").isNotNull(), F.col("here").isNull(), F.col("known").isNull()
        seen = both.agg(
            F.count_if(present).alias("p"), F.count_if(missing).alias("m"), F.count_if(odd).alias("o"), names(missing).alias("missing"),
            names(odd).alias("odd")
        )
        parts.append(
            section(
                seen, "Season Coverage", F.lit(season), present_count=F.col("p"), missing_count=F.col("m"), unexpected_count=F.col("o"),
                missing=F.nullif("missing", F.lit("")), unexpected=F.nullif("odd", F.lit(""))
            )
        )
    quiet = checks.agg(F.count_if(~F.col("passed")).alias("failed")).crossJoin(events.agg(F.count(F.lit(1)).alias("events"))).crossJoin(values.agg(F.coalesce(F.sum("nulls"), F.lit(0)).alias("nulls")))  # one row each
    parts.append(section(quiet.where("failed = 0 AND events = 0 AND nulls = 0"), "Notes", F.lit(dataset), message=F.lit("No data quality issues detected.")))
    return reduce(DataFrame.unionByName, parts)
