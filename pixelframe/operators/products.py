"""Product catalogue: season join, usefulness, integrity, top-k, composite identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names


def match(products: DataFrame, tile: str, start: str, end: str) -> DataFrame:
    """Products of a tile sensed in [start, end)."""
    return products.where((F.col("tile") == tile) & (F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz")))


def by_season(products: DataFrame, seasons: DataFrame) -> DataFrame:
    """Interval join ts in [start, end). The season table is a short list from a settings
    file; its size is checked before it is broadcast, else a range join by day is used."""
    if seasons.limit(1001).count() <= 1000:
        s = F.broadcast(seasons)
        return products.join(s, (F.col("ts") >= F.col("start")) & (F.col("ts") < F.col("end"))).drop("start", "end")
    days = seasons.withColumn("_day", F.explode(F.sequence(F.col("start").cast("date"), F.col("end").cast("date"))))
    keyed = products.withColumn("_day", F.col("ts").cast("date"))
    return keyed.join(days, "_day").where((F.col("ts") >= F.col("start")) & (F.col("ts") < F.col("end"))).drop("start", "end", "_day")


def with_useful(products: DataFrame) -> DataFrame:
    """useful = 100 - (mean cloud share * 100 + nodata percentage); NULL if either is missing."""
    return products.withColumn("useful", F.lit(100.0) - (F.col("cloud").cast("double") * 100.0 + F.col("nodata").cast("double")))


def useful_only(products: DataFrame, minimum: float = 0.0) -> DataFrame:
    return with_useful(products).where(F.col("useful") > minimum)


#: The bands whose shape tells whether a product arrived whole, and pixels a side.
CHECKED_BANDS = ("SCL_20m", "SCL_60m", "B01_10m", "B01_20m", "B01_60m")
SIDES = {10: 10980, 20: 5490, 60: 1830}


def intact(products: DataFrame, bands: DataFrame, key: str = "title") -> DataFrame:
    """Products all of whose checked bands are sound (none checked: sound)."""
    sound = bands.where("checked").groupBy(key).agg(F.bool_and("ok").alias("_ok"))
    return products.join(sound, key, "left").where(F.coalesce("_ok", F.lit(True))).drop("_ok")


def checked_bands(files: DataFrame, sides: dict[int, int] | None = None) -> DataFrame:
    """files(title, path, res, meta_side, read_side) with `checked` (the path names a checked
    band) and `ok`: both sides are those of the resolution, and the file name holds it."""
    side = F.element_at(F.create_map(*[F.lit(x) for kv in (sides or SIDES).items() for x in kv]), F.col("res").cast("int"))
    checked = F.lit(False)
    for name in CHECKED_BANDS:
        checked = checked | F.col("path").contains(name)
    ok = F.coalesce((F.col("meta_side") == side) & (F.col("read_side") == side) & names.file_name(F.col("path")).contains(F.col("res").cast("int").cast("string")), F.lit(False))
    return files.withColumns({"checked": checked, "ok": ok})


def search(products: DataFrame, start: str, end: str, kind: str = "MSIL2A", prefix: str = "S2", cloud: tuple[float, float] = (0.0, 100.0)) -> DataFrame:
    """The catalogue's products of a mission and type, sensed in [start, end), with a cloud
    percentage in a closed range; the newest first, then by title."""
    t, percent = F.col("title"), F.col("cloud").cast("double") * 100.0
    inside = (F.col("ts") >= F.lit(start).cast("timestamp_ntz")) & (F.col("ts") < F.lit(end).cast("timestamp_ntz"))
    return products.where(t.startswith(prefix) & (F.split(t, "_")[1] == kind) & percent.between(*cloud) & inside).orderBy(F.desc("ts"), "title")


def by_title(wanted: DataFrame, products: DataFrame) -> DataFrame:
    """The catalogue rows of the wanted titles (distinct)."""
    return wanted.select("title").distinct().join(products, "title")


def known_composites(identities: DataFrame, existing: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Composites that exist already, by title, and those that must still be made."""
    have = existing.select("composite_title").distinct()
    return identities.join(have, "composite_title", "left_semi"), identities.join(have, "composite_title", "left_anti")


def all_tiles(*frames: DataFrame) -> DataFrame:
    """The distinct tiles of several frames."""
    out = frames[0].select("tile")
    for f in frames[1:]:
        out = out.unionByName(f.select("tile"))
    return out.where("tile IS NOT NULL").distinct()


def skipped(tiles: DataFrame, seasonal: DataFrame, n_seasons: int, k: int = 1) -> DataFrame:
    """(tile, reason) of the wanted tiles that can't be handled: no product at all, or a season
    without any. seasonal: the products that are left after all filters."""
    n = seasonal.groupBy("tile").agg(F.countDistinct("season").alias("_n"))
    reason = F.when(F.col("_n").isNull(), "no products").otherwise(F.concat((F.lit(n_seasons) - F.col("_n")).cast("string"), F.lit(" seasons without products")))
    return tiles.select("tile").distinct().join(n, "tile", "left").where(F.coalesce("_n", F.lit(0)) < n_seasons).select("tile", reason.alias("reason"))


def top_k(products: DataFrame, k: int, keys: tuple[str, ...] = ("tile", "season")) -> DataFrame:
    """The k most useful products of each group; equal ones by title."""
    w = Window.partitionBy(*keys).orderBy(F.desc("useful"), "title")
    return products.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def complete_tiles(products: DataFrame, n_seasons: int) -> DataFrame:
    """Products of tiles that have a product in every season."""
    full = products.groupBy("tile").agg(F.countDistinct("season").alias("n")).where(F.col("n") == n_seasons).select("tile")
    return products.join(full, "tile", "left_semi")


def composite_identity(products: DataFrame, keys: tuple[str, ...] = ("tile", "season"), training: bool = True) -> DataFrame:
    """Hash of the sorted titles and the mode, date range, title and sources of each composite.
    Products of different tiles in one composite are an error."""
    g = products.groupBy(*keys).agg(F.array_sort(F.collect_list("title")).alias("titles"), F.min("ts").alias("first_date"), F.max("ts").alias("last_date"), F.min(names.title_tile(F.col("title"))).alias("title_tile"), F.max(names.title_tile(F.col("title"))).alias("_other"))
    g = g.withColumn("title_tile", F.when(F.col("title_tile") != F.col("_other"), F.raise_error(F.concat_ws(" ", F.lit("a composite of tiles"), "title_tile", "_other"))).otherwise(F.col("title_tile"))).drop("_other")
    g = g.withColumn("hash", F.sha2(F.concat(F.array_join("titles", ""), F.lit("0" if training else "1")), 256))
    fmt = lambda c: F.date_format(c, "yyyyMMdd")
    return g.withColumn("composite_title", names.composite_title(fmt("first_date"), fmt("last_date"), F.col("title_tile"), F.col("hash"), training))


def not_done(wanted: DataFrame, done: DataFrame, key: str = "tile") -> DataFrame:
    """Wanted keys without an output yet: distinct and sorted."""
    return wanted.select(key).distinct().join(done.select(key).distinct(), key, "left_anti").orderBy(key)


def first_resolution(rasters: DataFrame) -> DataFrame:
    """For each product and raster name the first path listed: bands before indexes, then by
    path, which puts the finest resolution first."""
    w = Window.partitionBy("title", "season", F.upper("name")).orderBy(F.desc("is_band"), "path")
    return rasters.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def whitelisted(rasters: DataFrame, indexes: tuple[str, ...], excluded: tuple[str, ...]) -> DataFrame:
    name = F.lower("name")
    return rasters.where(F.when(F.col("is_band"), ~name.isin(*excluded)).otherwise(name.isin(*indexes)))


def used_rasters(rasters: DataFrame, used_columns: list[str]) -> DataFrame:
    """Rasters whose column (season_name) a model uses; the season must match exactly."""
    return rasters.where(F.concat_ws("_", F.lower("season"), F.lower("name")).isin(*[c.lower() for c in used_columns]))


def product_rasters(products: DataFrame, listing: DataFrame) -> DataFrame:
    """(title, path, is_band): listed band files, then index and intermediate rasters of the
    product documents (maps of structs with a raster key; a missing map gives none)."""
    bands = listing.select("title", "path", F.lit(True).alias("is_band"))
    for c in ("indexes", "intermediate"):
        if c in products.columns:
            bands = bands.unionByName(products.select("title", F.explode(F.map_values(c)).alias("r")).select("title", F.col("r.rasterS3Key").alias("path"), F.lit(False).alias("is_band")))
    return bands


def merge_indexes(existing: str = "indexes", new: str = "new_indexes"):
    """Union of two index maps in which entries that exist already win."""
    old = F.col(existing)
    return F.map_concat(F.map_filter(F.col(new), lambda k, v: ~F.array_contains(F.map_keys(old), k)), old)


def availability(products: DataFrame, keys: tuple[str, ...] = ("tile", "season"), partial: float = 10.0) -> DataFrame:
    """Tier of each group by nodata percentage: 0 none, 1 one partial product, 2 one complete,
    3 several and all partial; NULL otherwise."""
    g = products.groupBy(*keys).agg(F.count("nodata").alias("n"), F.min("nodata").alias("low"), F.max("nodata").alias("high"))
    tier = F.when(F.col("n") == 0, 0).when((F.col("n") == 1) & (F.col("high") > partial), 1).when(F.col("n") == 1, 2).when(F.col("low") > partial, 3)
    return g.withColumn("tier", tier)


def quality_map(products: DataFrame, value: str = "nodata") -> DataFrame:
    """One JSON object a tile: season -> title -> value (rounded to 6 places)."""
    per = products.groupBy("tile", "season").agg(F.array_sort(F.collect_list(F.struct("title", F.round(value, 6).alias("v")))).alias("m"))
    seasons = F.transform(F.array_sort(F.collect_list(F.struct("season", "m"))), lambda s: F.struct(s["season"], F.map_from_entries(s["m"])))
    return per.groupBy("tile").agg(F.to_json(F.map_from_entries(seasons)).alias("json"))


def availability_log(products: DataFrame, keys: tuple[str, ...] = ("tile", "season")) -> DataFrame:
    """One line of text for each group whose availability is poor (tiers 0 to 3)."""
    text = F.when(F.col("tier") == 0, "no product").when(F.col("tier") == 1, "one product, not complete").when(F.col("tier") == 2, "one product, complete").otherwise("several products, none complete")
    return availability(products, keys).where("tier IS NOT NULL").select(*keys, "tier", F.concat_ws(" ", *[F.concat(F.lit(f"{k}="), F.col(k)) for k in keys], text).alias("line"))


def classified_share(tiles: DataFrame, fractions: DataFrame) -> DataFrame:
    """tiles with nodata_fraction, two decimals as text; "1" for a tile that has no raster."""
    return tiles.join(fractions.select("tile", "nodata_fraction"), "tile", "left").withColumn("nodata_fraction", F.coalesce("nodata_fraction", F.lit("1")))
