"""Labels and feature assembly: points to pixels, 3 x 3 stamping, wide feature tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geo


def assign_tiles(points: DataFrame) -> DataFrame:
    return points.withColumn("tile", geo.mgrs_tile(F.col("lat"), F.col("lon")))


def to_pixels(points: DataFrame, grids: DataFrame, res: float = 10.0) -> DataFrame:
    """Row and column of each point in its tile's grid (zone, x0, y0, height, width)."""
    p = points.join(grids, "tile")
    east, north = geo.utm(F.col("lat"), F.col("lon"), F.col("zone"))
    row, col = geo.pixel(east, north, F.col("x0"), F.col("y0"), res)
    return p.withColumns({"row": row, "col": col})


def stamp(points: DataFrame, keys: list[str], fields: list[str], order: str, height: int | None = None, width: int | None = None) -> DataFrame:
    """Each point labels its pixel and the 8 around it; where stamps overlap the later point
    wins. Pixels outside the grid are left out."""
    steps = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    p = points.withColumn("_r", F.explode(steps)).withColumn("_c", F.explode(steps))
    p = p.withColumn("row", F.col("row") + F.col("_r")).withColumn("col", F.col("col") + F.col("_c"))
    p = p.where((F.col("row") >= 0) & (F.col("col") >= 0))
    if height is not None:
        p = p.where((F.col("row") < height) & (F.col("col") < width))
    last = F.max_by(F.struct(*fields), F.col(order)).alias("_l")
    return p.groupBy(*keys, "row", "col").agg(last).select(*keys, "row", "col", "_l.*")


def label_mask(grid: DataFrame, labels: DataFrame, keys: list[str]) -> DataFrame:
    """The grid with masked = true where no label lies."""
    marked = labels.select(*keys, "row", "col", F.lit(False).alias("_m"))
    return grid.join(marked, [*keys, "row", "col"], "left").withColumn("masked", F.coalesce("_m", F.lit(True))).drop("_m")


def assemble(layers: list[DataFrame], keys: list[str]) -> DataFrame:
    """Feature columns side by side: equi-joins on the pixel key, which share one partitioning."""
    return reduce(lambda a, b: a.join(b, [*keys, "row", "col"]), layers)


def widen(rasters: DataFrame, keys: list[str], season: str = "season", name: str = "name", value: str = "v", columns: list[str] | None = None) -> DataFrame:
    """Long rows to one column for each season_name (a known list avoids a pass)."""
    long = rasters.withColumn("_c", F.concat_ws("_", season, name))
    return long.groupBy(*keys, "row", "col").pivot("_c", columns).agg(F.first(value))


def union_tiles(frames: list[DataFrame]) -> DataFrame:
    """Tile datasets by column name; a column that a tile lacks is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
