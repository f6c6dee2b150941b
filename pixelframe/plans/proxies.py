"""Views over the plain tables that stand in for rasters, products, points and results.

Each is given once as a Spark frame and once as SQL with equal content.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BANDS = ("B01", "B02", "B03", "B04", "B05", "B06", "B07", "B08", "B8A", "B09", "B11", "B12")
SEASON_LIST = (("spring", "1996-03-01", "1996-06-01"), ("summer", "1996-06-01", "1996-09-01"), ("autumn", "1996-09-01", "1996-12-01"))
SEASONS_JSON = "{" + ", ".join(f'"{n}": {{"start": "{a}", "end": "{b}"}}' for n, a, b in SEASON_LIST) + "}"
LC_CODES = {"click": 1, "view": 2, "purchase": 3}


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def px(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    value = lambda i: F.when((F.col("vec_id") * 31 + i) % 17 == 0, 0.0).otherwise(F.floor((F.col("embedding")[i].cast("double") + 1.0) * 5000.0).cast("double"))
    return e.select(
        "vec_id", (F.col("label") % 4).cast("int").alias("tile"), F.floor(F.col("vec_id") / 25).cast("long").alias("row"), (F.col("vec_id") % 25).alias("col"),
        ((F.col("vec_id") * 7) % 12).cast("int").alias("scl"), F.col("label").cast("int").alias("lc"), *[value(i).alias(b) for i, b in enumerate(BANDS)],
    )


PX = (
    "px AS (SELECT vec_id, CAST(label % 4 AS INT) AS tile, vec_id // 25 AS row, vec_id % 25 AS col, CAST((vec_id * 7) % 12 AS INT) AS scl, CAST(label AS INT) AS lc, "
    + ", ".join(f"CASE WHEN (vec_id * 31 + {i}) % 17 = 0 THEN 0.0::DOUBLE ELSE floor((embedding[{i + 1}]::DOUBLE + 1) * 5000) END AS {b}" for i, b in enumerate(BANDS))
    + " FROM embeddings), pv AS (SELECT vec_id, tile, row, col, scl, lc, "
    + ", ".join(f"NULLIF({b}, 0) AS {b}" for b in BANDS)
    + " FROM px)"
)


def grid(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select((F.col("vec_id") % 500).alias("row"), F.floor(F.col("vec_id") / 500).cast("int").alias("tile"), F.posexplode("embedding").alias("col", "v"))
    return e.select("tile", "row", F.col("col").cast("long").alias("col"), F.col("v").cast("double").alias("v"))


GRID = "grid AS (SELECT CAST(vec_id // 500 AS INT) AS tile, vec_id % 500 AS row, CAST(i - 1 AS BIGINT) AS col, embedding[i]::DOUBLE AS v FROM embeddings, range(1, 65) t(i))"


def products(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    k = F.col("o_orderkey")
    tile = F.concat(F.lit("30SU"), F.translate(F.substring("o_orderpriority", 1, 1), "12345", "EFGHJ"))
    day = F.date_format("o_orderdate", "yyyyMMdd")
    title = F.concat(F.when(k % 2 == 0, "S2A").otherwise("S2B"), F.lit("_MSIL2A_"), day, F.lit("T105031_N0300_R"), F.lpad((k % 143).cast("string"), 3, "0"), F.lit("_T"), tile, F.lit("_"), day, F.lit("T"), F.lpad(k.cast("string"), 9, "0"))
    return o.select(k.alias("product_id"), title.alias("title"), tile.alias("tile"), F.col("o_orderdate").alias("ts"), (k % 41).cast("double").alias("nodata"), ((k * 13) % 100).cast("double").__truediv__(F.lit(100.0)).alias("cloud"))


PRODUCTS = (
    "products AS (SELECT o_orderkey AS product_id, CASE WHEN o_orderkey % 2 = 0 THEN 'S2A' ELSE 'S2B' END || '_MSIL2A_' || strftime(o_orderdate, '%Y%m%d') || 'T105031_N0300_R' || lpad(CAST(o_orderkey % 143 AS VARCHAR), 3, '0') "
    "|| '_T30SU' || translate(substr(o_orderpriority, 1, 1), '12345', 'EFGHJ') || '_' || strftime(o_orderdate, '%Y%m%d') || 'T' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0') AS title, "
    "'30SU' || translate(substr(o_orderpriority, 1, 1), '12345', 'EFGHJ') AS tile, o_orderdate AS ts, (o_orderkey % 41)::DOUBLE AS nodata, ((o_orderkey * 13) % 100)::DOUBLE / 100.0::DOUBLE AS cloud FROM orders)"
)


def seasons(spark: SparkSession) -> DataFrame:
    from ..sources.readers import seasons_json

    return seasons_json(spark.range(1).select(F.lit(SEASONS_JSON).alias("value")), "value")


SEASONS = "seasons(season, s_start, s_end) AS (VALUES " + ", ".join(f"('{n}', TIMESTAMP '{a}', TIMESTAMP '{b}')" for n, a, b in SEASON_LIST) + ")"
SEASONAL = "seasonal AS (SELECT p.*, s.season, 100.0::DOUBLE - (cloud * 100.0::DOUBLE + nodata) AS useful FROM products p JOIN seasons s ON p.ts >= s.s_start AND p.ts < s.s_end)"


def obs(spark: SparkSession, d: str) -> DataFrame:
    q = table(spark, d, "lineitem")
    scl = F.round(F.col("l_discount") * 100).cast("int") % 12
    return q.select(F.col("l_returnflag").alias("tile"), F.col("l_partkey").alias("pixel"), F.col("l_suppkey").alias("product_id"), F.when(F.col("l_linenumber") == 1, 0.0).otherwise(F.col("l_extendedprice")).alias("v"), scl.alias("scl"))


OBS = "obs AS (SELECT l_returnflag AS tile, l_partkey AS pixel, l_suppkey AS product_id, CASE WHEN l_linenumber = 1 THEN 0.0::DOUBLE ELSE l_extendedprice END AS v, CAST(round(l_discount * 100) AS INT) % 12 AS scl FROM lineitem)"


def pts(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    lat, lon = F.lit(36.0) + (F.col("user_id") % 700).cast("double") / F.lit(100.0), F.lit(-9.0) + (F.col("event_id") % 1700).cast("double") / F.lit(100.0)
    return e.select(F.col("event_id").alias("point_ord"), lat.alias("lat"), lon.alias("lon"), F.col("event_type").alias("lc"), F.from_json("props", "k int")["k"].alias("sl"))


PTS = "pts AS (SELECT event_id AS point_ord, 36.0::DOUBLE + (user_id % 700)::DOUBLE / 100.0::DOUBLE AS lat, -9.0::DOUBLE + (event_id % 1700)::DOUBLE / 100.0::DOUBLE AS lon, event_type AS lc, CAST(json_extract(props, '$.k') AS INT) AS sl FROM events)"


def with_(*parts: str) -> str:
    return "WITH " + ", ".join(parts) + " "
