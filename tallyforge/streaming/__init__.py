"""Incremental loading: files that land become upserts of a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.repair import dedupe_keep_first
from ..sources import Warehouse


def upsert_landed(
    spark: SparkSession, path: str, schema: StructType, layer: str, name: str, keys: list[str], checkpoint: str, *, order: list[str],
    format: str = "json", repair: Callable[[DataFrame], DataFrame] = lambda df: df
) -> StreamingQuery:
    """Upsert each batch of files that landed under ``path``; ends when all there are have been taken.

    Of a key's rows in a batch the first by ``order`` counts, of equals the one whose whole content comes first, so that a batch that is
    run again gives the same table.
    """
    warehouse = Warehouse(spark)

    def batch(df: DataFrame, _: int) -> None:
        rows = repair(df)
        content = F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})
        first, _rest = dedupe_keep_first(rows.withColumn("_content", content), keys, *order, "_content")
        warehouse.write(first.drop("_content"), layer, name, "upsert", keys)

    return spark.readStream.schema(schema).format(format).load(path).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
