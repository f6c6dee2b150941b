"""Sinks: partitioned tables, metadata written last, class rasters and JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tile_dataset(df: DataFrame, path: str) -> None:
    """One partition a tile; a rerun replaces only the tiles it holds."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile").parquet(path)


def merged_dataset(spark: SparkSession, path: str) -> DataFrame:
    """All tile datasets present, columns by name, missing ones NULL."""
    return spark.read.option("mergeSchema", True).parquet(path)


def composite(blocks: DataFrame, metadata: DataFrame, path: str) -> None:
    """Blocks first, metadata last: a composite exists once its metadata row does. Both replace
    the tiles and seasons they hold. If anything fails, the metadata and blocks of these tiles
    and seasons are removed, so that nothing is left that readers take for whole."""
    spark = blocks.sparkSession
    parts = metadata.select("tile", "season").distinct().collect()  # the composites of one run
    try:
        for df, name in ((blocks, "blocks"), (metadata, "metadata")):
            df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile", "season").parquet(f"{path}/{name}")
    except Exception:
        for name in ("metadata", "blocks"):
            for r in parts:
                folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}/tile={r['tile']}/season={r['season']}")
                folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        raise


def class_raster(pixels: DataFrame, path: str, value: str = "code") -> None:
    """uint8 classes as short integers, checked to lie in 0 .. 255."""
    checked = pixels.withColumn(value, F.when(F.col(value).between(0, 255), F.col(value).cast("short")).otherwise(F.raise_error(F.lit("class code out of range")).cast("short")))
    checked.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("tile").parquet(path)


def model(fitted, metadata: dict, path: str, spark: SparkSession, confusion: DataFrame | None = None) -> None:
    """The fitted model, its metadata (name, columns, classes and the forest's settings) and, if
    given, the confusion table as CSV."""
    fitted.write().overwrite().save(f"{path}/model")
    settings = {k: str(v) for k, v in metadata.items() if k not in ("model", "used_columns", "classes")}
    row = (metadata["model"], list(metadata["used_columns"]), list(metadata["classes"]), settings)
    spark.createDataFrame([row], "model string, used_columns array<string>, classes array<string>, settings map<string,string>").coalesce(1).write.mode("overwrite").json(f"{path}/metadata")
    if confusion is not None:
        confusion.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{path}/confusion")


def report(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def quality_feature(ring: str = "ring", fraction: str = "nodata_fraction"):
    """A tile's GeoJSON feature: its outline, name and nodata fraction."""
    properties = F.struct(F.col("tile").alias("tile"), F.col(fraction).alias("nodata"))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))
    return F.struct(F.lit("Feature").alias("type"), properties.alias("properties"), geometry.alias("geometry"))


def quality_geojson(tiles: DataFrame) -> DataFrame:
    """One row: the FeatureCollection of tiles(tile, ring, nodata_fraction), by tile (a few
    thousand 100 km squares cover all land)."""
    one = tiles.agg(F.array_sort(F.collect_list(F.struct("tile", quality_feature().alias("f")))).alias("s"))
    return one.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.transform("s", lambda x: x["f"]).alias("features"))).alias("geojson"))


def ensure_table(spark: SparkSession, database: str, table: str, schema: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{table} ({schema}) USING parquet")
