"""Raster operators on pixel rows (tile, row, col, value) and on stored blocks.

Blocks are for storage and exchange; pixels appear only inside a stage. Every operator is
keyed by (tile, row, col): nothing depends on the order of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.indices import is_cloud, valid

RANGES = {"band": (0.0, 7000.0), "slope": (0.0, 70.0), "aspect": (0.0, 360.0), "dem": (0.0, 2000.0)}


def to_blocks(pixels: DataFrame, keys: list[str], value: str, side: int = 512) -> DataFrame:
    """Rows of side x side pixels: data holds (position, value) in row-major order."""
    block = [F.floor(F.col("row") / side).cast("int").alias("block_row"), F.floor(F.col("col") / side).cast("int").alias("block_col")]
    cell = F.struct((F.col("row") % side * side + F.col("col") % side).cast("int").alias("at"), F.col(value).cast("float").alias("v"))
    return pixels.select(*keys, *block, cell.alias("cell")).groupBy(*keys, "block_row", "block_col").agg(F.array_sort(F.collect_list("cell")).alias("data"))


def to_pixels(blocks: DataFrame, keys: list[str], value: str, side: int = 512) -> DataFrame:
    p = blocks.select(*keys, "block_row", "block_col", F.explode("data").alias("c"))
    return p.select(*keys, (F.col("block_row") * side + F.floor(F.col("c.at") / side)).cast("long").alias("row"), (F.col("block_col") * side + F.col("c.at") % side).cast("long").alias("col"), F.col("c.v").alias(value))


def normalize(c: str | Column, low: float, high: float) -> Column:
    """Linear map of low to -1 and high to 1, not clipped; infinities become NULL."""
    x = (F.col(c) if isinstance(c, str) else c).cast("double")
    y = x * (2.0 / (high - low)) - (high + low) / (high - low)
    return F.when((F.abs(y) != float("inf")) & ~F.isnan(y), y)


def upsample(pixels: DataFrame, scale: int) -> DataFrame:
    """Nearest resampling to a grid `scale` times finer; no join, one row becomes scale**2."""
    steps = F.sequence(F.lit(0), F.lit(scale - 1))
    p = pixels.withColumn("_r", F.explode(steps)).withColumn("_c", F.explode(steps))
    return p.withColumn("row", F.col("row") * scale + F.col("_r")).withColumn("col", F.col("col") * scale + F.col("_c")).drop("_r", "_c")


def coarse_join(fine: DataFrame, coarse: DataFrame, scale: int, keys: list[str]) -> DataFrame:
    """Each fine pixel with the coarse pixel that contains it: an equi-join on divided keys."""
    c = coarse.withColumnsRenamed({"row": "_row", "col": "_col"})
    f = fine.withColumn("_row", F.floor(F.col("row") / scale)).withColumn("_col", F.floor(F.col("col") / scale))
    return f.join(c, [*keys, "_row", "_col"]).drop("_row", "_col")


def downsample(pixels: DataFrame, scale: int) -> DataFrame:
    """Nearest resampling to a grid `scale` times coarser: the pixel at each cell's centre."""
    mid = scale // 2
    p = pixels.where((F.col("row") % scale == mid) & (F.col("col") % scale == mid))
    return p.withColumn("row", F.floor(F.col("row") / scale)).withColumn("col", F.floor(F.col("col") / scale))


def crop(pixels: DataFrame, row: int, col: int, height: int, width: int) -> DataFrame:
    """The pixels of a window, re-based to it."""
    p = pixels.where(F.col("row").between(row, row + height - 1) & F.col("col").between(col, col + width - 1))
    return p.withColumn("row", F.col("row") - row).withColumn("col", F.col("col") - col)


def mask_outside(pixels: DataFrame, value: str, inside: Column) -> DataFrame:
    return pixels.withColumn(value, F.when(inside, F.col(value)))


def mosaic(layers: DataFrame, keys: list[str], value: str = "v", order: str = "ord") -> DataFrame:
    """First valid value of each pixel in layer order."""
    return layers.where(F.col(value).isNotNull()).groupBy(*keys, "row", "col").agg(F.min_by(value, order).alias(value))


def onto_grid(grid: DataFrame, values: DataFrame, keys: list[str], value: str, pad: float | None = None) -> DataFrame:
    """Values on a destination grid; uncovered pixels get `pad` (NULL: training mode)."""
    out = grid.join(values.select(*keys, "row", "col", value), [*keys, "row", "col"], "left")
    return out if pad is None else out.withColumn(value, F.coalesce(value, F.lit(pad)))


def reproject(grid: DataFrame, source: DataFrame, source_row: Column, source_col: Column, keys: list[str], value: str) -> DataFrame:
    """Nearest resampling by inverse mapping: each destination pixel computes its source pixel."""
    g = grid.withColumn("_row", source_row.cast("long")).withColumn("_col", source_col.cast("long"))
    s = source.select(*keys, F.col("row").alias("_row"), F.col("col").alias("_col"), value)
    return g.join(s, [*keys, "_row", "_col"], "left").drop("_row", "_col")


def composite(obs: DataFrame, keys: list[str], value: str = "v", scl: str | None = "scl", method: str = "median") -> DataFrame:
    """Pixel-wise median over products of values that are neither nodata nor cloud."""
    if method != "median":
        raise ValueError(f"composite method {method!r} is not known; only 'median' is")
    v = valid(value) if scl is None else F.when(~F.coalesce(is_cloud(scl), F.lit(False)), valid(value))
    return obs.groupBy(*keys).agg(F.median(v).alias(value))


def composite_blocks(blocks: DataFrame, keys: list[str]) -> DataFrame:
    """The same on blocks: products of a block meet in one row, and the median of a pixel is
    the middle of a short sorted array, so only blocks are exchanged, never pixels.
    data: equally long arrays of valid values (NULL: nodata or cloud)."""
    g = blocks.groupBy(*keys).agg(F.collect_list("data").alias("stack"))
    at = lambda s, i: F.get(s, i.cast("int"))
    middle = lambda s: F.when(F.size(s) > 0, (at(s, F.floor((F.size(s) - 1) / 2)) + at(s, F.floor(F.size(s) / 2))) / 2.0)
    n = F.size(F.col("stack")[0])
    pick = lambda i: F.array_sort(F.filter(F.transform("stack", lambda d: F.get(d, i)), lambda x: x.isNotNull()))
    return g.select(*keys, F.transform(F.sequence(F.lit(0), n - 1), lambda i: middle(pick(i))).alias("data"))


def complete_bands(listing: DataFrame, k: int | None = None, key: str = "composite", band: str = "band", product: str = "title") -> DataFrame:
    """Bands that all k products of a composite have; without k, all products that the listing
    has of that composite."""
    n = listing.groupBy(key, band).agg(F.countDistinct(product).alias("n"))
    if k is not None:
        return n.where(F.col("n") == k).select(key, band)
    own = listing.groupBy(F.col(key).alias("_key")).agg(F.countDistinct(product).alias("_k"))
    return n.join(own, F.col(key).eqNullSafe(F.col("_key")) & (F.col("n") == F.col("_k"))).select(key, band)


def mirrored(pixels: DataFrame, axis: str, size: int, reach: int) -> DataFrame:
    """The rows with copies reflected at both edges (d c b a | a b c d | d c b a)."""
    low = pixels.where(F.col(axis) < reach).withColumn(axis, -F.col(axis) - 1)
    high = pixels.where(F.col(axis) >= size - reach).withColumn(axis, F.lit(2 * size - 1) - F.col(axis))
    return pixels.unionByName(low).unionByName(high)


def box_sum(pixels: DataFrame, keys: list[str], value: str, height: int, width: int, n: int) -> DataFrame:
    """Sum over n x n pixels, offsets -(n // 2 - 1) .. n // 2 for even n, edges reflected.
    Two one-dimensional frames; a partition is one grid line, however large the raster."""
    below, above = -((n - 1) // 2), n // 2
    reach = max(above, -below)
    for axis, other, size in (("row", "col", height), ("col", "row", width)):
        w = Window.partitionBy(*keys, other).orderBy(axis).rangeBetween(below, above)
        padded = mirrored(pixels, axis, size, reach).withColumn(value, F.sum(value).over(w))
        pixels = padded.where(F.col(axis).between(0, size - 1))
    return pixels


def expand_mask(mask: DataFrame, keys: list[str], height: int, width: int, res: int, side: float = 600.0, share: float = 0.075, value: str = "mask") -> DataFrame:
    """Cloud mask widened: 1 where at least `share` of the surrounding box is cloud."""
    n = int(side / res)
    sums = box_sum(mask.select(*keys, "row", "col", F.col(value).cast("long").alias("_sum")), keys, "_sum", height, width, n)
    out = mask.join(sums, [*keys, "row", "col"])
    return out.withColumn(value, F.when(F.col("_sum") >= n * n * share, 1).otherwise(F.col(value)).cast("int")).drop("_sum")


def neighbours(pixels: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    """The 3 x 3 surroundings of each pixel as columns n00 .. n22 (NULL outside): lag and lead
    along columns, then along rows."""
    across = Window.partitionBy(*keys, "row").orderBy("col")
    p = pixels.withColumns({"_0": F.lag(value).over(across), "_1": F.col(value), "_2": F.lead(value).over(across)})
    down = Window.partitionBy(*keys, "col").orderBy("row")
    p = p.withColumns({f"n{r}{c}": {0: F.lag(f"_{c}").over(down), 1: F.col(f"_{c}"), 2: F.lead(f"_{c}").over(down)}[r] for r in range(3) for c in range(3)})
    return p.drop("_0", "_1", "_2")


def slope_aspect(dem: DataFrame, keys: list[str], res: float, value: str = "v") -> DataFrame:
    """Horn slope and aspect in degrees (aspect counter-clockwise from east); NULL at edges."""
    n = lambda r, c: F.col(f"n{r}{c}").cast("double")
    dx = ((n(0, 2) + 2.0 * n(1, 2) + n(2, 2)) - (n(0, 0) + 2.0 * n(1, 0) + n(2, 0))) / (8.0 * res)
    dy = ((n(0, 0) + 2.0 * n(0, 1) + n(0, 2)) - (n(2, 0) + 2.0 * n(2, 1) + n(2, 2))) / (8.0 * res)
    p = neighbours(dem, keys, value).withColumns({"_dx": dx, "_dy": dy})
    turn = F.degrees(F.atan2(-F.col("_dy"), -F.col("_dx")))
    p = p.withColumns({"slope": F.degrees(F.atan(F.sqrt(F.col("_dx") ** 2 + F.col("_dy") ** 2))), "aspect": F.when(turn < 0, turn + 360.0).otherwise(turn)})
    return p.drop("_dx", "_dy", *[f"n{r}{c}" for r in range(3) for c in range(3)])


def denoise(dem: DataFrame, keys: list[str], rounds: int = 1, limit: float = 10.0, value: str = "v") -> DataFrame:
    """Edge-keeping smoothing: the mean of those neighbours that differ by at most `limit`."""
    for _ in range(rounds):
        cells = F.array(*[f"n{r}{c}" for r in range(3) for c in range(3)])
        near = F.filter(cells, lambda x: F.abs(x - F.col(value)) <= limit)
        mean = F.aggregate(near, F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(near), F.lit(0))
        dem = neighbours(dem, keys, value).withColumn(value, F.coalesce(mean, value)).drop(*[f"n{r}{c}" for r in range(3) for c in range(3)])
    return dem


def dem_cells_of_tiles(cells: DataFrame, tiles: DataFrame) -> DataFrame:
    """(tile, cell) pairs whose extents overlap: cells are 1 x 1 degree from their south-west
    corner. Tiles are cut into the whole degrees they touch, so this is an equi-join."""
    span = lambda low, high: F.sequence(F.floor(low).cast("int"), F.greatest(F.ceil(high).cast("int") - 1, F.floor(low).cast("int")))
    t = tiles.withColumn("lat", F.explode(span("ymin", "ymax"))).withColumn("lon", F.explode(span("xmin", "xmax"))).select("tile", "lat", "lon")
    return t.join(cells, ["lat", "lon"]).select("tile", "name").distinct()


def nodata_share(pixels: DataFrame, keys: list[str], value: str = "v") -> DataFrame:
    zero = F.count_if(F.col(value) == 0)
    return pixels.groupBy(*keys).agg((zero * 100.0 / F.count("*")).alias("nodata_pct"), F.format_string("%.2f", zero / F.count("*")).alias("nodata_fraction"))


def masks_by_resolution(scl: DataFrame, sides: dict[int, int | tuple[int, int]], expanded: bool = True, keys: tuple[str, ...] = ("title",), side: float = 600.0, share: float = 0.075) -> DataFrame:
    """(keys, res, row, col, mask) from scene classes (keys, res, row, col, scl) at 20 and 60 m:
    each one's cloud mask, expanded for training, and at 10 m the 20 m one on the finer grid.
    sides: pixels a side (or height and width) at each resolution."""
    made = []
    for res in (20, 60):
        height, width = sides[res] if isinstance(sides[res], tuple) else (sides[res], sides[res])
        m = scl.where(F.col("res") == res).select(*keys, "row", "col", F.when(is_cloud("scl"), 1).otherwise(0).alias("mask"))
        made.append(expand_mask(m, list(keys), height, width, res, side, share) if expanded else m)
    fine = upsample(made[0], 2)
    out = [m.select(*keys, F.lit(res).alias("res"), F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("mask").cast("int").alias("mask")) for res, m in ((10, fine), (20, made[0]), (60, made[1]))]
    return out[0].unionByName(out[1]).unionByName(out[2])


def window_slices(grids: DataFrame, down: int, across: int) -> DataFrame:
    """Windows (row0, col0, height, width) of grids(tile, height, width): down x across of equal
    size, the last of each line with the remainder, so that no strip is left out."""
    at = lambda n, parts, i: F.floor(F.col(n) / parts) * i
    size = lambda n, parts, i: F.when(i == parts - 1, F.col(n) - at(n, parts, i)).otherwise(F.floor(F.col(n) / parts))
    g = grids.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(down - 1)))).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    i, j = F.col("i"), F.col("j")
    return g.select("tile", at("height", down, i).alias("row0"), at("width", across, j).alias("col0"), size("height", down, i).alias("h"), size("width", across, j).alias("w")).withColumnsRenamed({"h": "height", "w": "width"})


def terrain_source(kind: Column) -> Column:
    """Which store holds a terrain layer: elevations apart from what is derived from them."""
    return F.when(kind == "dem", "dem").when(kind.isin("slope", "aspect"), "derived").otherwise(F.raise_error(F.concat(F.lit("unknown terrain layer "), kind)))


def terrain(cells: DataFrame, tiles: DataFrame, values: DataFrame, grid: DataFrame, row: Column, col: Column, value: str = "v") -> DataFrame:
    """The elevation of each grid pixel of each tile. cells(name, lat, lon) and tiles(tile, xmin,
    ymin, xmax, ymax) give the cells of a tile; values(name, row, col, v), placed in
    the mosaic, are mosaicked by name, first value wins; grid(tile, row, col) is looked up at the mosaic position (row, col).
    A tile without any cell has no rows here: see missing_terrain."""
    of = dem_cells_of_tiles(cells, tiles)
    first = mosaic(of.join(values, "name").withColumnRenamed("name", "ord"), ["tile"], value)
    return reproject(grid.join(of.select("tile").distinct(), "tile", "left_semi"), first, row, col, ["tile"], value)


def missing_terrain(cells: DataFrame, tiles: DataFrame) -> DataFrame:
    """(tile, reason) of tiles that no elevation cell touches."""
    return tiles.select("tile").join(dem_cells_of_tiles(cells, tiles).select("tile").distinct(), "tile", "left_anti").withColumn("reason", F.lit("no elevation cell"))
