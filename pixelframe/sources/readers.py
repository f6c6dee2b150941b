"""Readers: labelled points, seasons, label maps, catalogues and raster blocks."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEASONS = "map<string,struct<start:date,end:date>>"


def file_order(raw: DataFrame, to: str) -> DataFrame:
    """raw with a number that ascends as its rows stand in their file, however Spark splits it:
    bytes before the file and the split, and rows before within the split. raw has `_m`, the
    file metadata, and `_i`, an ascending number in each task."""
    split = ["_m.file_path", "_m.file_block_start"]
    first = raw.groupBy(*[F.col(c) for c in split]).agg(F.min("_i").alias("_first"), F.first("_m.file_size").alias("_size"))  # a row a split
    files = first.groupBy("file_path").agg(F.max("_size").alias("_size"))
    before = files.withColumn("_before", F.sum("_size").over(Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1))).drop("_size")
    first = first.join(before, "file_path").drop("_size")
    first = F.broadcast(first)  # a row a split: 8,000 for a terabyte
    out = raw.withColumns({"file_path": F.col("_m.file_path"), "file_block_start": F.col("_m.file_block_start")}).join(first, ["file_path", "file_block_start"])
    return out.withColumn(to, F.coalesce("_before", F.lit(0)) + F.col("file_block_start") + F.col("_i") - F.col("_first")).drop("file_path", "file_block_start", "_before", "_first", "_m", "_i")


def points_csv(spark: SparkSession, path: str, lc: str = "category", sl: str | None = "subcategory", sep: str = ";") -> DataFrame:
    """point_ord (ascends in file order), lat, lon, lc, sl; rows without a position or
    first-level label are dropped."""
    raw = spark.read.option("sep", sep).option("header", True).csv(path)
    raw = file_order(raw.select("*", F.col("_metadata").alias("_m"), F.monotonically_increasing_id().alias("_i")), "point_ord")
    out = raw.select("point_ord", F.col("latitude").cast("double").alias("lat"), F.col("longitude").cast("double").alias("lon"), F.col(lc).alias("lc"), (F.col(sl) if sl and sl in raw.columns else F.lit(None).cast("string")).alias("sl"))
    return out.na.drop(subset=["lat", "lon", "lc"])


def points_geojson(spark: SparkSession, path: str, lc: str = "category", sl: str | None = "subcategory") -> DataFrame:
    """Point features of a GeoJSON file in file order."""
    props = ", ".join(f"`{c}`: string" for c in (lc, sl) if c)
    schema = f"type string, features array<struct<type: string, properties: struct<{props}>, geometry: struct<type: string, coordinates: array<double>>>>"
    f = spark.read.option("multiLine", True).schema(schema).json(path).select(F.posexplode("features").alias("point_ord", "f"))
    out = f.select("point_ord", F.col("f.geometry.coordinates")[1].alias("lat"), F.col("f.geometry.coordinates")[0].alias("lon"), F.col(f"f.properties.{lc}").alias("lc"), (F.col(f"f.properties.{sl}") if sl else F.lit(None).cast("string")).alias("sl"))
    return out.na.drop(subset=["lat", "lon", "lc"])


def description_table(description: Column) -> Column:
    """The cells of an HTML description table as a map: odd cells name the even ones."""
    cells = F.regexp_extract_all(description, F.lit("<td>(.*?)</td>"), F.lit(1))
    pick = lambda rest: F.transform(F.filter(cells, lambda x, i: i % 2 == rest), lambda x: F.trim(x))
    names, values = pick(0), pick(1)
    pairs = F.arrays_zip(F.slice(names, F.lit(1), F.size(values)).alias("k"), values.alias("v"))
    return F.map_from_entries(F.filter(pairs, lambda p: p["k"].isNotNull()))


def placemarks_kmz(spark: SparkSession, path: str) -> DataFrame:
    """name, description and lon, lat of the point placemarks of KMZ files."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for content in frame["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    root = ElementTree.fromstring(z.read("doc.kml"))
                ns = root.tag.partition("}")[0] + "}" if root.tag.startswith("{") else ""
                for i, mark in enumerate(root.iter(f"{ns}Placemark")):
                    where = mark.find(f"{ns}Point/{ns}coordinates")
                    if where is not None and where.text:
                        lon, lat = (float(x) for x in where.text.strip().split(",")[:2])
                        rows.append((i, mark.findtext(f"{ns}name"), mark.findtext(f"{ns}description"), lon, lat))
            yield pd.DataFrame(rows, columns=["point_ord", "name", "description", "lon", "lat"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(parse, "point_ord long, name string, description string, lon double, lat double")


def seasons(spark: SparkSession, path: str) -> DataFrame:
    """season, start, end (exclusive) of a seasons JSON file."""
    return seasons_json(spark.read.text(path, wholetext=True), "value")


def seasons_json(df: DataFrame, column: str) -> DataFrame:
    s = df.select(F.explode(F.from_json(column, SEASONS)).alias("season", "s"))
    return s.select("season", F.col("s.start").cast("timestamp_ntz").alias("start"), F.col("s.end").cast("timestamp_ntz").alias("end"))


def label_map(spark: SparkSession, path: str, reserved: dict[str, int]) -> DataFrame:
    """label, code; reserved labels override the file."""
    m = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,int>")).alias("label", "code"))
    r = spark.createDataFrame(list(reserved.items()), "label string, code int")
    return m.join(r.select("label"), "label", "left_anti").unionByName(r)


def catalogue(spark: SparkSession, path: str, kind: str = "parquet") -> DataFrame:
    return spark.read.format(kind).load(path)


def listing(spark: SparkSession, path: str, prefix: str = "") -> DataFrame:
    """Objects below a folder whose name there starts with the prefix (column pruning: contents
    are not read)."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toString().rstrip("/")
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", "length", "modificationTime")
    return found.where(F.col("path").startswith(f"{root}/{prefix}"))


def sample_raster(rasters: DataFrame, tile: str) -> DataFrame:
    """The tile's reference grid: the first 10 m band, by path, of any of its products; an
    error if there is none."""
    one = rasters.where(F.col("title").rlike(f"_T{tile}_") & (F.col("res") == 10)).agg(F.min_by(F.struct(*rasters.columns), "path").alias("r"))
    found = F.when(F.col("r").isNull(), F.raise_error(F.lit(f"no 10 m band of tile {tile}")).cast(one.schema["r"].dataType)).otherwise(F.col("r"))
    return one.select(found.alias("r")).select("r.*")


def models(spark: SparkSession, path: str) -> DataFrame:
    """The second-level models below a folder: (model, used_columns, classes) of each class."""
    found = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "part-*.json").schema("model string, used_columns array<string>, classes array<string>").json(path)
    return found.where("model IS NOT NULL AND NOT contains(model, 'land-cover')")


def blocks(spark: SparkSession, path: str, tiles: list[str] | None = None) -> DataFrame:
    """Raster blocks, with partition pruning by tile."""
    b = spark.read.parquet(path)
    return b if tiles is None else b.where(F.col("tile").isin(tiles))


def classification(spark: SparkSession, path: str, tile: str) -> DataFrame:
    return spark.read.parquet(path).where(F.col("tile") == tile)
