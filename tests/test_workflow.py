"""The runs end to end on a small made-up tile."""

import pytest
from pyspark.sql import functions as F

from pixelframe.functions import geo
from pixelframe.plans import workflow
from pixelframe.plans.settings import Mode, Settings, tiles_of_area

SIZE = 24


@pytest.fixture(scope="module")
def tables(spark):
    seasons = spark.sql("SELECT s season, to_timestamp_ntz(a) start, to_timestamp_ntz(b) end FROM VALUES ('spring','2021-03-01','2021-06-01'),('summer','2021-06-01','2021-09-01') t(s,a,b)")
    prods = spark.sql(
        "SELECT concat('S2A_MSIL2A_', d, 'T105031_N0300_R051_T', tile, '_', d, 'T13543', n) title, tile, to_timestamp_ntz(d, 'yyyyMMdd') ts, 0.1D cloud, cast(n as double) nodata "
        "FROM VALUES ('20210401','30SUF',1),('20210411','30SUF',2),('20210421','30SUF',3),('20210701','30SUF',1),('20210401','30SUG',1) t(d,tile,n)"
    )
    pixels = spark.range(SIZE * SIZE).select(F.floor(F.col("id") / SIZE).alias("row"), (F.col("id") % SIZE).alias("col"))
    value = F.when(F.col("col") < SIZE // 2, 3000).otherwise(600) + F.hash("title", "band", "row", "col") % 50
    bands = prods.select("title").crossJoin(F.broadcast(spark.sql("SELECT explode(array('B02','B03','B04','B08')) band"))).crossJoin(F.broadcast(pixels))
    bands = bands.withColumn("v", F.when((F.col("row") == 0) & (F.col("band") == "B08"), 0).otherwise(F.when(F.col("band") == "B08", value).otherwise(500 + F.col("col"))))
    masks = bands.where("row = 5 AND band = 'B02' AND title LIKE '%20210401%'").select("title", "row", "col", F.lit(1).alias("mask"))
    x0, y0 = 320000.0, 4080000.0
    at = lambda r, c: geo.geographic(F.lit(x0) + (c + 0.5) * 10, F.lit(y0) - (r + 0.5) * 10, F.lit(30))
    p = pixels.where("row % 6 = 3 AND col % 6 = 3")
    lat, lon = at(F.col("row"), F.col("col"))
    points = p.select(lat.alias("lat"), lon.alias("lon"), F.when(F.col("col") < SIZE // 2, "green").otherwise("bare").alias("lc"), F.lit("x").alias("sl"), (F.col("row") * SIZE + F.col("col")).alias("point_ord"))
    points = spark.createDataFrame(points.collect(), points.schema)  # as read from a file: plain columns
    grids = spark.createDataFrame([("30SUF", 30, x0, y0)], "tile string, zone int, x0 double, y0 double")
    return prods, seasons, bands, masks, points, grids


def test_run(spark, tables):
    prods, seasons, bands, masks, points, grids = tables
    s = Settings(min_useful=30.0, max_products=2, lc_codes={"green": 1, "bare": 2}, sl_codes={"x": 2})
    data = workflow.training(prods, seasons, bands, masks, points, grids, s).cache()
    assert data.select("tile").distinct().collect()[0][0] == "30SUF" and data.count() == 16 * 9
    assert {"spring_B08", "summer_ndvi", "spring_product_name", "LC", "SL", "latitude"} <= set(data.columns)
    assert data.first()["summer_product_name"].startswith("S2E_MSIL2A_20210701_")
    fitted, used, matrix = workflow.train_land_cover(data, s, trees=5, depth=4)
    assert sum(r["n"] for r in matrix.collect()) > 0 and all(r["n"] == 0 for r in matrix.collect() if r["pred"] != r["actual"])
    out = workflow.prediction(Mode.LAND_COVER_PREDICTION, prods, seasons, bands, masks, {"land-cover": fitted}, {"land-cover": used}, s).cache()
    assert out.count() == SIZE * SIZE
    assert {r["code"] for r in out.where("row = 0").collect()} == {0}
    assert {r["code"] for r in out.where("row > 0 AND col < 12").collect()} == {1}
    second = workflow.prediction(Mode.SECOND_LEVEL_PREDICTION, prods, seasons, bands, masks, {}, {}, s, land_cover=out.withColumnRenamed("predicted", "lc"))
    assert {r["code"] for r in second.collect()} == {0, 1}
    with pytest.raises(ValueError):
        workflow.prediction(Mode.TRAINING, prods, seasons, bands, masks, {}, {}, s)
    assert workflow.training(prods, seasons, bands, masks, points, grids, s, done=prods.select("tile")).count() == 0


def test_area(spark):
    got = {r["tile"] for r in tiles_of_area(spark, 36.5, 37.0, -5.2, -4.5).collect()}
    assert "30SUF" in got and len(got) < 5


def test_settings(monkeypatch):
    monkeypatch.setenv("PIXELFRAME_MAX_PRODUCTS", "3")
    assert Settings.from_environment().max_products == 3


def test_settings_json(monkeypatch):
    monkeypatch.setenv("PIXELFRAME_TILES", '["30SUF", "30SUG"]')
    monkeypatch.setenv("PIXELFRAME_LC_CODES", '{"green": 1}')
    s = Settings.from_environment()
    assert s.tiles == ["30SUF", "30SUG"] and s.lc_codes == {"green": 1}
    monkeypatch.setenv("PIXELFRAME_TILES", "30SUF")
    with pytest.raises(ValueError, match="no JSON"):
        Settings.from_environment()
    monkeypatch.setenv("PIXELFRAME_TILES", "{}")
    with pytest.raises(ValueError, match="JSON list"):
        Settings.from_environment()


def test_area_edges(spark):
    # zone seam at 0 degrees, and a far edge that no whole step reaches
    got = {r["tile"] for r in tiles_of_area(spark, 39.9, 40.02, -0.01, 0.01, step=0.5).collect()}
    assert {"30TYK", "31TBE"} <= got


def test_training_as_dealt(spark, tables):
    """Products that did not arrive whole go before the best are taken, clouds are expanded,
    composites that exist are used again."""
    prods, seasons, bands, _, points, grids = tables
    s = Settings(min_useful=30.0, max_products=1, sides={10: SIZE, 20: SIZE // 2, 60: SIZE // 6})
    best = prods.where("title LIKE '%20210401T%30SUF%'").first()["title"]
    title, side = F.col("title"), SIZE // 2
    files = prods.where("tile = '30SUF'").select("title", F.lit("x/SCL_20m.jp2").alias("path"), F.lit(20).alias("res"), F.lit(side).alias("meta_side"), F.when(title == best, 3).otherwise(side).alias("read_side"))
    chosen = workflow.selected(prods, seasons, s, 2, files)
    assert {r["title"][11:19] for r in chosen.collect()} == {"20210411", "20210701"}
    reasons = dict(map(tuple, workflow.left_out(prods.select("tile").union(spark.sql("SELECT '30SUH'")), prods, seasons, s, files).collect()))
    assert reasons == {"30SUG": "1 seasons without products", "30SUH": "no products"}
    cells = spark.range(SIZE * SIZE).select(F.floor(F.col("id") / SIZE).alias("row"), (F.col("id") % SIZE).alias("col"))
    cloud = F.when((F.col("row") == 2) & (F.col("col") == 3), 9).otherwise(4)
    scl = prods.select("title").crossJoin(F.broadcast(spark.sql("SELECT explode(array(20, 60)) res"))).crossJoin(F.broadcast(cells.where(f"row < {SIZE // 2} AND col < {SIZE // 2}")))
    scl = scl.where(f"res = 20 OR (row < {SIZE // 6} AND col < {SIZE // 6})").withColumn("scl", F.when(F.col("res") == 20, cloud).otherwise(4))
    small = Settings(**{**s.__dict__, "cloud_side": 60.0, "cloud_share": 1 / 9})
    wide = workflow.masks_of(chosen, None, scl, small, True).where("mask = 1").select("title", "row", "col").collect()
    assert {(r["row"], r["col"]) for r in wide} == {(r, c) for r in range(2, 8) for c in range(4, 10)} and len({r["title"] for r in wide}) == 2
    plain = workflow.masks_of(chosen, None, scl, small, False).where("mask = 1").collect()
    assert {(r["row"], r["col"]) for r in plain} == {(4, 6), (4, 7), (5, 6), (5, 7)}
    data = workflow.training(prods, seasons, bands, None, points, grids, small, files=files, scl=scl).cache()
    assert data.where("row = 3 AND col = 9 AND spring_B08 IS NOT NULL").count() == 0 and data.count() == 16 * 9
    masks = workflow.masks_of(chosen, None, scl, small, True)
    comp = workflow.composites(chosen, bands, masks)
    identities = workflow.products.composite_identity(chosen).select("tile", "season", "composite_title")
    old = comp.join(identities, ["tile", "season"]).withColumn("B08", F.lit(77.0)).where("season = 'spring'")
    again = workflow.composites_again(chosen, bands, masks, None, old, True)
    assert again.where("season = 'spring' AND B08 <> 77").count() == 0 and again.where("season = 'summer' AND B08 = 77").count() == 0
    assert again.count() == comp.count()
    assert workflow.needed_bands(["spring_ndvi", "summer_B02", "slope"], ["spring", "summer"]) == ["B02", "B04", "B08"]


def test_second_level(spark):
    rows = [("a" if i % 2 else "b", f"{'xy'[(i // 2) % 2]}{i % 2}", float(i), float(i), float((i // 2) % 2) + i * 1e-4, "30SUF", i, i) for i in range(80)]
    data = spark.createDataFrame(rows, "LC string, SL string, latitude double, longitude double, spring_B08 double, tile string, row int, col int")
    got = workflow.train_second_level(data, Settings(), trees=3, depth=3)
    assert set(got) == {"a", "b"}
    for parent, (_, used, matrix) in got.items():
        assert used == ["spring_B08"] and sum(r["n"] for r in matrix.collect()) == 8
        assert all(r["n"] == 0 for r in matrix.collect() if r["pred"] != r["actual"])
        parts = workflow.second_level_rows(data, Settings(), parent).groupBy("part").count().collect()
        assert dict(map(tuple, parts)) == {"train": 32, "test": 8}
