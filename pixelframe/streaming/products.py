"""Incremental product selection: new product files, late ones up to a watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..operators import products


def read(spark: SparkSession, path: str, schema: StructType, late: str = "30 days") -> DataFrame:
    return spark.readStream.schema(schema).parquet(path).withWatermark("ts", late)


def select_each_batch(stream: DataFrame, seasons: DataFrame, minimum: float, k: int, sink: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs season join, usefulness and top-k on each batch of new products."""

    def batch(df: DataFrame, number: int) -> None:
        sink(products.top_k(products.useful_only(products.by_season(df, seasons), minimum), k), number)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
