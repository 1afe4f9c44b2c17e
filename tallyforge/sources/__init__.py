"""Landed files, layered tables, SQL over all of them, snapshots and run records."""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.repair import upsert

#: Layers in order; an export of one includes those before it.
LAYERS = ("bronze", "silver", "gold")


def freshest(manifest: DataFrame, prefer: str = "json") -> DataFrame:
    """Of the candidate extracts (dataset, format, path, committed_at) the latest of each dataset; of equals the preferred format."""
    order = Window.partitionBy("dataset").orderBy(F.col("committed_at").desc_nulls_last(), (F.col("format") == prefer).desc(), "path")
    return manifest.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth")


def read_landed(spark: SparkSession, path: str, format: str, schema: StructType | None = None) -> DataFrame:
    """A landed file or folder; JSON is an array of records, "jsonl" has one on each line, CSV has a header."""
    options = {"json": {"multiLine": True}, "csv": {"header": True}}.get(format, {})
    reader = spark.read.format("json" if format == "jsonl" else format).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def load_freshest(spark: SparkSession, manifest: DataFrame, dataset: str, schema: StructType | None = None, *, prefer: str = "json") -> DataFrame:
    """The rows of the extract of ``dataset`` that ``freshest`` prefers, read in that extract's own format."""
    chosen = freshest(manifest.where(F.col("dataset") == dataset), prefer).collect()  # one row
    if not chosen:
        raise ValueError(f"no extract of {dataset}")
    return read_landed(spark, chosen[0].path, chosen[0].format, schema)


def save_csv(df: DataFrame, path: str) -> None:
    """Rows as CSV files with headers."""
    df.write.mode("overwrite").option("header", True).csv(path)


def normalised_columns(df: DataFrame, renames: dict[str, str] | None = None) -> DataFrame:
    """Column names trimmed, in lower case, with underscores for spaces; then renamed."""
    names = [c.strip().lower().replace(" ", "_") for c in df.columns]
    return df.toDF(*[(renames or {}).get(c, c) for c in names])


def with_lineage(df: DataFrame, run_id: str, dataset: str, at: str) -> DataFrame:
    """Adds ingest_run_id, source_dataset (where it has none) and ingested_at."""
    source = F.coalesce(F.col("source_dataset"), F.lit(dataset)) if "source_dataset" in df.columns else F.lit(dataset)
    return df.withColumns({"ingest_run_id": F.lit(run_id), "source_dataset": source, "ingested_at": F.to_timestamp(F.lit(at))})


def signatures(spark: SparkSession, path: str) -> DataFrame:
    """Path, size and SHA-256 of each file under a folder."""
    return spark.read.format("binaryFile").load(path).select("path", "length", F.sha2("content", 256).alias("sha256"))


class Warehouse:
    """Tables in the databases of LAYERS, by layer and name; new databases are under ``location`` if it is given, else in the session's warehouse."""

    def __init__(self, spark: SparkSession, layers: tuple[str, ...] = LAYERS, location: str | None = None):
        self.spark, self.layers = spark, layers
        for layer in layers:
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}" + (f" LOCATION '{location}/{layer}'" if location else ""))

    def list_tables(self, layer: str | None = None) -> list[tuple[str, str]]:
        return [(x, t.name) for x in self.layers if layer in (None, x) for t in self.spark.catalog.listTables(x) if not t.isTemporary]

    def resolve(self, name: str, layer: str | None = None) -> tuple[str, str]:
        """(layer, table) of ``name`` or ``layer.name``; an unknown or ambiguous name, or another layer than asked for, is an error."""
        stated, _, table = name.rpartition(".")
        if stated and layer and stated != layer:
            raise ValueError(f"{name} isn't in layer {layer}")
        found = [x for x in self.list_tables(stated or layer) if x[1] == table]
        if len(found) != 1:
            raise ValueError(f"{name}: {'no such table' if not found else 'in several layers'}; there are {self.list_tables()}")
        return found[0]

    def load(self, name: str, layer: str | None = None) -> DataFrame:
        return self.spark.table(".".join(self.resolve(name, layer)))

    def describe(self, name: str) -> DataFrame:
        return self.spark.sql(f"DESCRIBE TABLE {'.'.join(self.resolve(name))}").select("col_name", "data_type")

    def sql(self, text: str) -> DataFrame:
        """SQL over all tables, as ``layer.table`` or, where only one layer has it, ``table``."""
        names = self.list_tables()
        for layer, table in names:
            if sum(t == table for _, t in names) == 1:
                self.spark.table(f"{layer}.{table}").createOrReplaceTempView(table)
        return self.spark.sql(text)

    def write(self, df: DataFrame, layer: str, name: str, mode: str = "overwrite", keys: list[str] | None = None) -> None:
        """Write a table: overwrite, append, or upsert on ``keys`` (append without keys).

        An overwrite or upsert writes a new table, puts the old one aside, and drops that once the new one has its name: a
        table may be made from itself, and a run that ends in between leaves the old rows as ``<name>_before_<id>``.
        """
        table, id = f"{layer}.{name}", uuid.uuid4().hex
        there = self.spark.catalog.tableExists(table)
        if mode == "append" or mode == "upsert" and not keys:
            df.write.mode("append").saveAsTable(table)
        elif not there:
            df.write.mode("overwrite").saveAsTable(table)
        else:
            new = upsert(self.spark.table(table), df, keys) if mode == "upsert" else df
            new.write.saveAsTable(f"{table}_{id}")
            self.spark.sql(f"ALTER TABLE {table} RENAME TO {table}_before_{id}")
            self.spark.sql(f"ALTER TABLE {table}_{id} RENAME TO {table}")
            self.spark.sql(f"DROP TABLE {table}_before_{id}")

    def row_counts(self) -> DataFrame:
        counts = [
            self.spark.table(f"{x}.{t}").agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(x).alias("layer"), F.lit(t).alias("table_name"), "n_rows"
            ) for x,
            t in self.list_tables()
        ]
        return reduce(DataFrame.unionByName, counts)

    def existing_keys(self, name: str, keys: list[str]) -> DataFrame:
        """Distinct keys of a table; no other column is read."""
        return self.load(name).select(*keys).distinct()

    def missing_tables(self, expected: list[str]) -> list[str]:
        """Those of ``expected`` (``layer.table``) that aren't there."""
        there = {f"{x}.{t}" for x, t in self.list_tables()}
        return sorted(set(expected) - there)

    def export(self, layer: str, path: str) -> DataFrame:
        """Snapshot of a layer and those before it under ``path``; gives, and writes as JSON, the manifest: table, path, rows, checksum and the latest run.

        The checksum is the sum of the rows' hashes, so it tells content, whatever the files and the order, and comes from a pass over the rows.
        """
        kept, entries = self.layers[: self.layers.index(layer) + 1], []
        for x, t in self.list_tables():
            if x in kept:
                self.spark.table(f"{x}.{t}").write.mode("overwrite").parquet(f"{path}/{x}/{t}")
                rows = self.spark.read.parquet(f"{path}/{x}/{t}")
                total = F.coalesce(F.sum(F.xxhash64(*rows.columns).cast("decimal(20,0)")), F.lit(0)).cast("string")
                entries.append(
                    rows.agg(F.count(F.lit(1)).alias("n_rows"), total.alias("checksum")).select(
                        F.lit(x).alias("layer"), F.lit(t).alias("table_name"), F.lit(f"{path}/{x}/{t}").alias("path"), "n_rows", "checksum"
                    )
                )
        manifest = reduce(DataFrame.unionByName, entries)
        run = latest_run(self).select("run_id", "environment", "status") if ("bronze", "ingestion_runs") in self.list_tables() else None
        if run is None:
            manifest = manifest.withColumns({c: F.lit(None).cast("string") for c in ("run_id", "environment", "status")})
        else:
            manifest = manifest.join(F.broadcast(run), F.lit(True), "left")  # one row
        manifest.write.mode("overwrite").json(f"{path}/_manifest")
        return self.spark.read.schema(manifest.schema).json(f"{path}/_manifest")


def open_run(warehouse: Warehouse, environment: str, at: str, *, layer: str = "bronze", **notes: str) -> str:
    """Record a run as started in the layer's ingestion_runs; gives its id."""
    run_id = str(uuid.uuid4())
    schema = "run_id string, environment string, run_started_at timestamp, run_finished_at timestamp, status string, notes string"
    row = warehouse.spark.range(1).select(
        F.lit(run_id).alias("run_id"), F.lit(environment).alias("environment"), F.to_timestamp(F.lit(at)).alias("run_started_at"),
        F.lit(None).cast("timestamp").alias("run_finished_at"), F.lit("running").alias("status"), F.lit(json.dumps(notes)).alias("notes")
    )
    warehouse.write(row.to(StructType.fromDDL(schema)), layer, "ingestion_runs", "append")
    return run_id


def close_run(warehouse: Warehouse, run_id: str, status: str, at: str, *, layer: str = "bronze") -> None:
    run = warehouse.load(f"{layer}.ingestion_runs").where(F.col("run_id") == run_id)
    warehouse.write(
        run.withColumn("status", F.lit(status)).withColumn("run_finished_at", F.to_timestamp(F.lit(at))), layer, "ingestion_runs", "upsert",
        ["run_id"]
    )


def latest_run(warehouse: Warehouse, layer: str = "bronze") -> DataFrame:
    return warehouse.load(f"{layer}.ingestion_runs").orderBy(F.desc("run_started_at")).limit(1)
