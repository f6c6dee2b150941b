"""The three runs end to end: feature dataset, land-cover and second-level prediction.

Inputs are tables: products(title, tile, ts, cloud, nodata), seasons(season, start, end),
bands(title, band, row, col, v) on one grid, masks(title, row, col, mask) or scene classes
scl(title, res, row, col, scl), from which training makes expanded masks and prediction plain
ones; points(lat, lon, lc, sl, point_ord), grids(tile, zone, x0, y0), terrain(tile, row, col,
slope, aspect, dem); files(title, path, res, meta_side, read_side) to leave out products that
did not arrive whole; existing composites (composite_title, tile, season, row, col, bands) to
be used again. All tiles are handled by one job; tiles without products in every season are
left out, and left_out() says why.
"""

from __future__ import annotations

import os
import tempfile
import warnings

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import indices
from ..operators import features, model, products, raster
from .settings import Mode, Settings

KEYS = ["tile"]


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared checkpoint folder. Composites and labels are results
    of their own, read by several later steps; storing them also keeps plans short."""
    sc = df.sparkSession.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(sc.getConf().get("spark.checkpoint.dir") or os.path.join(tempfile.gettempdir(), "pixelframe-checkpoints"))
    return df.checkpoint()


def usable(prods: DataFrame, seasons: DataFrame, s: Settings, files: DataFrame | None = None) -> DataFrame:
    """Products of a season that are useful enough and, if their files are known, whole."""
    useful = products.with_useful(products.by_season(prods, seasons)).where(F.col("useful") > s.min_useful)
    return useful if files is None else products.intact(useful, products.checked_bands(files, {int(k): v for k, v in s.sides.items()}))


def selected(prods: DataFrame, seasons: DataFrame, s: Settings, n_seasons: int, files: DataFrame | None = None) -> DataFrame:
    """The best products of each tile and season, for tiles that have some in every season."""
    return stored(products.complete_tiles(products.top_k(usable(prods, seasons, s, files), s.max_products), n_seasons))


def left_out(tiles: DataFrame, prods: DataFrame, seasons: DataFrame, s: Settings, files: DataFrame | None = None) -> DataFrame:
    """(tile, reason) of the wanted tiles that a run leaves out."""
    return products.skipped(tiles, usable(prods, seasons, s, files), seasons.select("season").distinct().count())


def masks_of(chosen: DataFrame, masks: DataFrame | None, scl: DataFrame | None, s: Settings, training: bool) -> DataFrame:
    """Masks on the grid of the bands: those given, or made from scene classes."""
    if scl is None:
        return masks
    sides = {int(k): v for k, v in s.sides.items()}
    made = raster.masks_by_resolution(scl.join(chosen.select("title").distinct(), "title", "left_semi"), sides, expanded=training, side=s.cloud_side, share=s.cloud_share)
    return made.where(F.col("res") == s.resolution).drop("res")


def needed_bands(used: list[str], seasons: list[str]) -> list[str]:
    """The bands behind feature columns season_name: bands themselves and the inputs of indexes."""
    found = set()
    for c in used:
        season = next((x for x in seasons if c.lower().startswith(f"{x.lower()}_")), None)
        if season is not None:
            name = c[len(season) + 1 :]
            found |= set(indices.INDEXES[name][0]) if name in indices.INDEXES else {name}
    return sorted(found)


def composites(chosen: DataFrame, bands: DataFrame, masks: DataFrame, only: DataFrame | None = None, names: list[str] | None = None) -> DataFrame:
    """(tile, season, row, col, band columns): cloud-free medians. only: pixels to keep, joined
    before the median, so training touches labelled pixels alone. names: the bands to make."""
    if names is not None:
        bands = bands.where(F.col("band").isin(names))
    obs = bands.join(chosen.select("title", "tile", "season"), "title")
    if only is not None:
        obs = obs.join(only.select("tile", "row", "col"), ["tile", "row", "col"], "left_semi")
    obs = obs.join(masks, ["title", "row", "col"], "left").withColumn("v", F.when(F.coalesce("mask", F.lit(0)) == 0, indices.valid("v")))
    # A band enters a composite only if all its products have it.
    have = chosen.select("tile", "season", "title").join(bands.select("title", "band").distinct(), "title").groupBy("tile", "season", "band").agg(F.count("*").alias("n"))
    want = chosen.groupBy("tile", "season").agg(F.count("*").alias("n"))
    complete = have.join(want, ["tile", "season", "n"]).select("tile", "season", "band")
    obs = obs.join(complete, ["tile", "season", "band"], "left_semi")
    names = names or sorted(r["band"] for r in bands.select("band").distinct().collect())  # a dozen names
    return stored(obs.groupBy("tile", "season", "row", "col").pivot("band", names).agg(F.median("v")))


def composites_again(chosen: DataFrame, bands: DataFrame, masks: DataFrame, only: DataFrame | None, existing: DataFrame | None, training: bool, names: list[str] | None = None) -> DataFrame:
    """As composites, but those that exist already, by title, are read and not made."""
    if existing is None:
        return composites(chosen, bands, masks, only, names)
    identities = products.composite_identity(chosen, training=training).select("tile", "season", "composite_title")
    known, missing = products.known_composites(identities, existing)
    made = composites(chosen.join(missing.select("tile", "season"), ["tile", "season"], "left_semi"), bands, masks, only, names)
    old = existing.join(known.select("composite_title"), "composite_title", "left_semi").drop("composite_title")
    if only is not None:
        old = old.join(only.select("tile", "row", "col"), ["tile", "row", "col"], "left_semi")
    keep = [c for c in old.columns if names is None or c in names or c in ("tile", "season", "row", "col")]
    return made.unionByName(old.select(*keep), allowMissingColumns=True)


def season_features(comp: DataFrame, seasons: list[str]) -> DataFrame:
    """Normalised bands and feature indexes, one column for each season_name, of the pixels that
    every season has: one exchange for all seasons."""
    bands = [c for c in comp.columns if c not in ("tile", "season", "row", "col") and c.lower() not in indices.EXCLUDED_BANDS]
    made = [n for n in indices.FEATURE_INDEXES if set(indices.INDEXES[n][0]) <= set(bands)]
    wide = comp.select("tile", "season", "row", "col", *[raster.normalize(b, *raster.RANGES["band"]).alias(b) for b in bands], *[indices.index(n).alias(n) for n in made])
    columns = [F.max(F.when(F.col("season") == season, F.col(c))).alias(f"{season}_{c}") for season in seasons for c in [*bands, *made]]
    one = wide.groupBy("tile", "row", "col").agg(F.countDistinct("season").alias("_n"), *columns)
    return stored(one.where(F.col("_n") == len(seasons)).drop("_n"))


def with_terrain(df: DataFrame, terrain: DataFrame | None) -> DataFrame:
    """Terrain columns; NULL where there is no terrain, which training drops and prediction
    classifies as nodata."""
    if terrain is None:
        return df
    t = terrain.select("tile", "row", "col", *[raster.normalize(c, *raster.RANGES[c]).alias(c) for c in ("slope", "aspect", "dem")])
    return df.join(t, ["tile", "row", "col"], "left")


def training(prods: DataFrame, seasons: DataFrame, bands: DataFrame, masks: DataFrame | None, points: DataFrame, grids: DataFrame, s: Settings, terrain: DataFrame | None = None, done: DataFrame | None = None, files: DataFrame | None = None, scl: DataFrame | None = None, existing: DataFrame | None = None) -> DataFrame:
    """The feature dataset: one row a labelled pixel."""
    names = sorted(r["season"] for r in seasons.select("season").collect())
    if done is not None:
        prods = prods.join(done.select("tile").distinct(), "tile", "left_anti")
    chosen = selected(prods, seasons, s, len(names), files)
    located = stored(features.to_pixels(stored(features.assign_tiles(points)), grids, float(s.resolution)))
    labels = stored(features.stamp(located.withColumnsRenamed({"lc": s.lc_property, "sl": s.sl_property, "lat": "latitude", "lon": "longitude"}), KEYS, [s.lc_property, "longitude", "latitude", s.sl_property], "point_ord"))
    comp = composites_again(chosen, bands, masks_of(chosen, masks, scl, s, True), labels, existing, True)
    wide = with_terrain(season_features(comp, names), terrain)
    for season in names:
        title = products.composite_identity(chosen.where(F.col("season") == season)).select("tile", F.col("composite_title").alias(f"{season}_product_name"))
        wide = wide.join(title, "tile")
    return stored(wide.join(labels, ["tile", "row", "col"]))


def prediction(mode: Mode, prods: DataFrame, seasons: DataFrame, bands: DataFrame, masks: DataFrame | None, models: dict[str, PipelineModel], used: dict[str, list[str]], s: Settings, terrain: DataFrame | None = None, land_cover: DataFrame | None = None, done: DataFrame | None = None, files: DataFrame | None = None, scl: DataFrame | None = None, existing: DataFrame | None = None) -> DataFrame:
    """(tile, row, col, predicted, code) of every pixel. models and used: by first-level class,
    or under 'land-cover'. Second level needs the land-cover classes (tile, row, col, lc).
    Only the bands behind the used columns are read."""
    if mode is Mode.TRAINING:
        raise ValueError("prediction has no training mode")
    if mode is Mode.LAND_COVER_PREDICTION and land_cover is not None:
        warnings.warn("land_cover is ignored in land-cover prediction", stacklevel=2)
    names = sorted(r["season"] for r in seasons.select("season").collect())
    if done is not None:
        prods = prods.join(done.select("tile").distinct(), "tile", "left_anti")
    chosen = selected(prods, seasons, s, len(names), files)
    needed = needed_bands([c for columns in used.values() for c in columns], names) or None
    comp = composites_again(chosen, bands, masks_of(chosen, masks, scl, s, False), None, existing, False, needed)
    wide = with_terrain(season_features(comp, names), terrain)
    if mode is Mode.LAND_COVER_PREDICTION:
        out = model.predict(models["land-cover"], wide, used["land-cover"])
        return out.select("tile", "row", "col", "predicted", model.encode(F.col("predicted"), s.lc_codes, {model.NODATA: 0}).alias("code"))
    out = model.route(wide.join(land_cover.select("tile", "row", "col", "lc"), ["tile", "row", "col"]), models, used)
    return out.select("tile", "row", "col", "predicted", model.encode(F.col("predicted"), s.sl_codes, {model.NODATA: 0, model.NOCLASSIFIED: 1}).alias("code"))


def second_level_rows(dataset: DataFrame, s: Settings, parent: str) -> DataFrame:
    """The rows of a first-level class that have a second-level one, with their part."""
    rows = stored(model.clean(dataset.where(F.col(s.lc_property) == parent)))
    return stored(model.back_join(rows, model.safe_split(rows, s.sl_property, s.second_fraction)))


def train_second_level(dataset: DataFrame, s: Settings, **options) -> dict[str, tuple[PipelineModel, list[str], DataFrame]]:
    """For each first-level class with two second-level classes or more: the model, its feature
    columns and the (pred, actual, n) table of held-out locations (the number of classes is
    bounded by the label map)."""
    found = dataset.where(F.col(s.sl_property).isNotNull()).groupBy(s.lc_property).agg(F.countDistinct(s.sl_property).alias("n")).where("n >= 2")
    out = {}
    for r in found.orderBy(s.lc_property).collect():
        rows = second_level_rows(dataset, s, r[s.lc_property])
        used = [c for c in model.feature_columns(rows, (s.lc_property, s.sl_property, "tile", "row", "col")) if c != "part"]
        fitted = model.fit_forest(rows.where("part = 'train'"), used, s.sl_property, **options)
        out[r[s.lc_property]] = fitted, used, model.confusion(model.predict(fitted, rows.where("part = 'test'"), used), "predicted", s.sl_property)
    return out


def train_land_cover(dataset: DataFrame, s: Settings, **options) -> tuple[PipelineModel, list[str], DataFrame]:
    """The model, its feature columns and the (pred, actual, n) table of held-out locations."""
    df = stored(model.clean(dataset, drop=(s.sl_property,)))
    used = model.feature_columns(df, (s.lc_property, s.sl_property, "tile", "row", "col"))
    parts = model.safe_split(df, s.lc_property, s.train_fraction)
    rows = stored(model.back_join(df, parts))
    fitted = model.fit_forest(rows.where("part = 'train'"), used, s.lc_property, **options)
    return fitted, used, model.confusion(model.predict(fitted, rows.where("part = 'test'"), used), "predicted", s.lc_property)
