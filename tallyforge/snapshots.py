"""Snapshots of feature tables side by side, and events that are told once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import surrogate_key


def snapshot_row(runs: DataFrame, **otherwise: str) -> DataFrame:
    """One row (snapshot_id, ingest_run_id, environment, notes): of the latest run, or, where there is none, of the given environment and notes.

    The id is a digest of the run, so a load that is run again has the same one; without a run it is a digest of what was given.
    """
    latest = runs.orderBy(F.desc("run_started_at"), F.desc("run_id")).limit(1)
    notes = otherwise.get("notes", "feature snapshot")
    row = latest.select(F.col("run_id").cast("string").alias("ingest_run_id"), F.col("environment").cast("string").alias("environment"))
    default = runs.sparkSession.range(1).select(
        F.lit(None).cast("string").alias("ingest_run_id"), F.lit(otherwise.get("environment")).cast("string").alias("environment")
    )
    there = latest.select(F.lit(1).alias("_there"))
    both = row.unionByName(default.join(there, F.lit(True), "left_anti"))
    return both.select(
        surrogate_key(F.col("ingest_run_id"), F.col("environment")).alias("snapshot_id"), "ingest_run_id", "environment",
        F.lit(notes).alias("notes")
    )


def write_snapshot(df: DataFrame, path: str, snapshot: DataFrame | str) -> None:
    """Writes ``df`` under ``path`` as the partition of a snapshot (its id, or a row of ``snapshot_row``). A snapshot that is there already is replaced, others stay as they are."""
    id = snapshot if isinstance(snapshot, str) else snapshot.first().snapshot_id
    stamped = df.drop("snapshot_id").withColumn("snapshot_id", F.lit(id))
    stamped.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("snapshot_id").parquet(path)


def read_snapshot(spark: SparkSession, path: str, snapshots: DataFrame, *, at: str | None = None) -> DataFrame:
    """Rows of the latest snapshot (of those that ``snapshots`` (snapshot_id, taken_at) lists) taken up to ``at``, or of all the latest. Only its partition is read."""
    known = snapshots if at is None else snapshots.where(F.col("taken_at") <= F.to_timestamp(F.lit(at)))
    chosen = known.orderBy(F.desc("taken_at"), F.desc("snapshot_id")).limit(1).collect()  # one row
    rows = spark.read.option("basePath", path).parquet(path).withColumn("snapshot_id", F.col("snapshot_id").cast("string"))
    return rows.where(F.col("snapshot_id") == chosen[0].snapshot_id) if chosen else rows.where("false")


def event_key(*parts: Column) -> Column:
    """Digest by which an event is known again."""
    return F.sha1(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)))


def new_events(events: DataFrame, seen: DataFrame, key: str = "event_key") -> DataFrame:
    """Events whose key ``seen`` lacks, one for each key: the least by content."""
    rest = [c for c in events.columns if c != key]
    one = events.groupBy(key).agg(F.min(F.struct(*rest)).alias("row")).select(key, "row.*").select(*events.columns)
    return one.join(seen.select(key).distinct(), key, "left_anti").select(*events.columns)


def record_events(events: DataFrame, path: str, run: str, key: str = "event_key") -> DataFrame:
    """The events that no earlier run has told; they are stored under ``path`` as the partition of this run.

    What the run itself stored before, whole or in part, isn't counted as seen and is replaced: a run that is repeated half-way tells the
    same events again, and stores them once.
    """
    spark = events.sparkSession
    try:
        seen = spark.read.option("basePath", path).parquet(path).where(F.col("run").cast("string") != run).select(key)
    except Exception as e:  # nothing is stored yet
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        seen = events.select(key).where("false")
    fresh = new_events(events, seen, key)
    fresh.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    schema = fresh.withColumn("run", F.lit("")).schema
    return spark.read.schema(schema).option("basePath", path).parquet(path).where(F.col("run") == run).drop("run")
