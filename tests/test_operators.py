"""Operators against small cases worked out by hand."""

import math

import pytest
from pyspark.sql import functions as F

from pixelframe.functions import geo, indices, names
from pixelframe.operators import features, model, products, raster
from pixelframe.sources import readers, sinks


def one(df):
    return df.first()


BANDS = {"B02": 500, "B03": 800, "B04": 600, "B05": 900, "B08": 3000, "B8A": 3100, "B09": 3200, "B11": 1800}
EXPECTED = {
    "moisture": 0.2653061224, "ndvi": 0.6666666667, "ndsi": 0.0, "ndwi": -0.5789473684, "evi2": 1.599555679, "osavi": 0.7732989645, "ndre": 0.5609756098,
    "mndwi": -0.3846153846, "bri": 4.62962963e-08, "evi": 2.104524728, "ndyi": 0.2307692308, "ri": -0.1428571429, "cri1": 1.6, "bsi": -0.186440678,
}


def test_indexes(spark):
    df = spark.createDataFrame([tuple(BANDS.values()), (0,) * len(BANDS), (None,) * len(BANDS)], ", ".join(f"{b} long" for b in BANDS))
    full, zero, null = indices.with_indexes(df).collect()
    for name, value in EXPECTED.items():
        assert math.isclose(full[name], value, rel_tol=1e-8, abs_tol=1e-12), name
        assert zero[name] == null[name] == (0.0 if name == "ndsi" else None)


def test_valid_and_register(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (2.0,)], "b double")
    assert [r[0] for r in df.select(indices.valid("b")).collect()] == [None, None, 2.0]
    indices.register("twice", ("b",), lambda b: 2.0 * b)
    assert [r[0] for r in df.select(indices.index("twice")).collect()] == [None, None, 4.0]
    del indices.INDEXES["twice"]


def test_useful_and_threshold(spark):
    p = spark.createDataFrame([("a", 0.25, 5.0), ("b", None, 5.0), ("c", 0.1, 0.0)], "title string, cloud double, nodata double")
    assert [r["title"] for r in products.useful_only(p, 70.0).collect()] == ["c"]


def test_normalize(spark):
    df = spark.createDataFrame([(0.0,), (3500.0,), (7000.0,), (8000.0,), (float("inf"),)], "v double")
    got = [r[0] for r in df.select(raster.normalize("v", 0, 7000)).collect()]
    assert got[:3] == [-1.0, 0.0, 1.0] and math.isclose(got[3], 9 / 7) and got[4] is None


def test_median(spark):
    data = [(1, 100.0, 4), (1, 0.0, 4), (1, 300.0, 4), (1, 200.0, 9), (2, 0.0, 4), (2, 0.0, 4), (3, 5.0, None)]
    df = spark.createDataFrame(data, "pixel int, v double, scl int")
    assert {r["pixel"]: r["v"] for r in raster.composite(df, ["pixel"]).collect()} == {1: 200.0, 2: None, 3: 5.0}
    with pytest.raises(ValueError):
        raster.composite(df, ["pixel"], method="mean")
    blocks = spark.createDataFrame([(0, [100.0, None]), (0, [300.0, None]), (0, [None, 7.0])], "b int, data array<double>")
    assert one(raster.composite_blocks(blocks, ["b"]))["data"] == [200.0, 7.0]


TITLES = ["S2A_MSIL2A_20210401T105031_N0300_R051_T30SUF_20210401T135434", "S2B_MSIL2A_20210416T105019_N0300_R051_T30SUF_20210416T134220"]


@pytest.mark.parametrize("training,expected", [(True, "S2E_MSIL2A_20210401_NXXX_RXXX_T30SUF_20210416_526094a2"), (False, "S2S_MSIL2A_20210401_NXXX_RXXX_T30SUF_20210416_fde5583f")])
def test_composite_title(spark, training, expected):
    df = spark.createDataFrame([(t,) for t in reversed(TITLES)], "title string").select("title", F.lit("30SUF").alias("tile"), F.lit("s").alias("season"), names.title_date(F.col("title")).alias("ts"))
    assert one(products.composite_identity(df, training=training))["composite_title"] == expected


def grid(spark, cells, h=24, w=24):
    return spark.createDataFrame([(0, r, c, int((r, c) in cells)) for r in range(h) for c in range(w)], "tile int, row long, col long, mask int")


@pytest.mark.parametrize("cells,count,box", [({(r, c) for r in (10, 11, 12) for c in (10, 11, 12)}, 64, (7, 14)), ({(10, 10)}, 1, (10, 10)), ({(r, c) for r in (0, 1) for c in (0, 1)}, 22, (0, 4))])
def test_expand_mask(spark, cells, count, box):
    got = [r for r in raster.expand_mask(grid(spark, cells), ["tile"], 24, 24, 60).collect() if r["mask"]]
    assert len(got) == count
    assert all(box[0] <= r["row"] <= box[1] and box[0] <= r["col"] <= box[1] for r in got)


@pytest.mark.parametrize("lat,lon,east,north,tile", [(33.768333, 35.706111, 750615.732, 3739760.794, "36SYC"), (33.485278, 35.317778, 715347.273, 3707490.942, "36SYC"), (36.800986, -5.017507, 320012.809, 4074694.200, "30SUF"), (36.847580, -4.914143, 329338.745, 4079674.079, "30SUF")])
def test_projection(spark, lat, lon, east, north, tile):
    p = spark.createDataFrame([(lat, lon)], "lat double, lon double").withColumn("z", geo.zone(F.col("lat"), F.col("lon")))
    e, n = geo.utm(F.col("lat"), F.col("lon"), F.col("z"))
    r = one(p.select(e.alias("e"), n.alias("n"), geo.mgrs_tile(F.col("lat"), F.col("lon")).alias("t"), "z"))
    # the positions are given to a millionth of a degree, about 0.11 m
    assert abs(r["e"] - east) < 0.06 and abs(r["n"] - north) < 0.06 and r["t"] == tile
    back = geo.geographic(F.lit(r["e"]), F.lit(r["n"]), F.lit(r["z"]))
    got = one(p.select(back[0].alias("a"), back[1].alias("b")))
    assert abs(got["a"] - lat) < 1e-7 and abs(got["b"] - lon) < 1e-7


def test_zones(spark):
    df = spark.createDataFrame([(60.0, 4.0), (78.0, 10.0), (10.0, 179.99), (-10.0, -180.0)], "lat double, lon double")
    assert [r[0] for r in df.select(geo.zone(F.col("lat"), F.col("lon"))).collect()] == [32, 33, 60, 1]


def test_cells_and_rings(spark):
    df = spark.createDataFrame([("N22E037",), ("S05W010",)], "n string")
    lat, lon = geo.parse_cell(F.col("n"))
    assert [tuple(r) for r in df.select(lat, lon).collect()] == [(22, 37), (-5, -10)]
    ring = spark.createDataFrame([([[0.0, 0.0], [4.0, 0.0], [4.0, 2.0], [0.0, 2.0], [0.0, 0.0]],), ([[1.0, 1.0]],)], "r array<array<double>>")
    a, b = ring.select(geo.centroid(F.col("r")).alias("c"), geo.contains(F.col("r"), F.lit(1.0), F.lit(1.0)).alias("i"), geo.contains(F.col("r"), F.lit(5.0), F.lit(1.0)).alias("o")).collect()
    assert (a["c"]["lat"], a["c"]["lon"], a["i"], a["o"]) == (1.0, 2.0, True, False) and b["c"]["lat"] is None


def test_stamp(spark):
    p = spark.createDataFrame([(0, 1, 5, 5, "A"), (0, 2, 5, 7, "B"), (0, 3, 0, 0, "C")], "tile int, ord int, row long, col long, lc string")
    got = {(r["row"], r["col"]): r["lc"] for r in features.stamp(p, ["tile"], ["lc"], "ord", 20, 20).collect()}
    assert sum(v == "A" for v in got.values()) == 6 and sum(v == "B" for v in got.values()) == 9 and sum(v == "C" for v in got.values()) == 4
    assert got[5, 6] == "B"


def test_confusion(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), (None, "a")], "p string, a string")
    assert {(r["pred"], r["actual"]): r["n"] for r in model.confusion(df, "p", "a").collect()} == {("a", "a"): 1, ("a", "b"): 1, ("b", "a"): 0, ("b", "b"): 1}


@pytest.mark.parametrize("values,tier", [([], 0), ([12.0], 1), ([10.0], 2), ([11.0, 30.0], 3), ([5.0, 30.0], None)])
def test_tiers(spark, values, tier):
    df = spark.createDataFrame([("t", "s", v) for v in values or [None]], "tile string, season string, nodata double")
    assert one(products.availability(df))["tier"] == tier


def test_split_is_disjoint(spark):
    df = spark.createDataFrame([("x" if i % 2 else "y", i % 50, i % 30, i) for i in range(600)], "LC string, latitude int, longitude int, v int")
    split = model.safe_split(df, "LC")
    joined = model.back_join(df, split)
    assert joined.count() == 600
    assert joined.groupBy("latitude", "longitude").agg(F.countDistinct("part").alias("n")).where("n > 1").isEmpty()


def test_forest_precedence(spark):
    data = [(i, "a" if i % 2 else "b", float(i % 2) + 0.1, 1.0) for i in range(60)]
    df = spark.createDataFrame(data, "id int, LC string, f double, g double")
    fitted = model.fit_forest(df, ["f", "g"], "LC", trees=3, depth=3)
    test = spark.createDataFrame([(1, 1.1, 1.0), (2, 0.1, 1.0), (3, None, 1.0), (4, float("inf"), 1.0)], "id int, f double, g double")
    assert {r["id"]: r["predicted"] for r in model.predict(fitted, test, ["f", "g"]).collect()} == {1: "a", 2: "b", 3: "nodata", 4: "nodata"}
    assert all(leaves >= 1 for leaves, _ in model.tree_statistics(fitted))
    rows = test.withColumn("lc", F.when(F.col("id") == 1, "k").when(F.col("id") == 2, "other").otherwise("nodata"))
    routed = model.route(rows, {"k": fitted}, {"k": ["f", "g"]})
    assert {r["id"]: r["predicted"] for r in routed.collect()} == {1: "a", 2: "noclassified", 3: "nodata", 4: "nodata"}


def test_grid_operators(spark):
    df = spark.createDataFrame([(0, r, c, float(r * 4 + c)) for r in range(4) for c in range(4)], "tile int, row long, col long, v double")
    assert raster.upsample(df, 2).count() == 64
    assert {r["v"] for r in raster.downsample(df, 2).collect()} == {5.0, 7.0, 13.0, 15.0}
    blocks = raster.to_blocks(df, ["tile"], "v", 2)
    assert blocks.count() == 4
    assert sorted(tuple(r) for r in raster.to_pixels(blocks, ["tile"], "v", 2).collect()) == sorted(tuple(r) for r in df.collect())
    s = {(r["row"], r["col"]): r for r in raster.slope_aspect(df, ["tile"], 1.0).collect()}
    assert math.isclose(s[1, 1]["slope"], math.degrees(math.atan(math.hypot(1, 4)))) and s[0, 0]["slope"] is None
    flat = df.withColumn("v", F.lit(3.0))
    assert {r["v"] for r in raster.denoise(flat, ["tile"]).collect()} == {3.0}


def test_dem_overlap(spark):
    cells = spark.createDataFrame([(y, x, f"{y},{x}") for y in range(3) for x in range(3)], "lat int, lon int, name string")
    inside = spark.createDataFrame([("t", 1.2, 1.4, 1.3, 1.5), ("u", 0.5, 1.5, 0.5, 1.5)], "tile string, ymin double, ymax double, xmin double, xmax double")
    got = {}
    for r in raster.dem_cells_of_tiles(cells, inside).collect():
        got.setdefault(r["tile"], set()).add(r["name"])
    assert got == {"t": {"1,1"}, "u": {"0,0", "0,1", "1,0", "1,1"}}


def test_readers_and_sinks(spark, tmp_path):
    (tmp_path / "p.csv").write_text("latitude;longitude;category;subcategory\n1.5;2.5;a;b\n;2.5;a;b\n3.5;4.5;c;\n")
    assert [(r["lat"], r["lon"], r["lc"], r["sl"]) for r in readers.points_csv(spark, str(tmp_path / "p.csv")).collect()] == [(1.5, 2.5, "a", "b"), (3.5, 4.5, "c", None)]
    (tmp_path / "p.geojson").write_text('{"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"category": "a", "subcategory": "b"}, "geometry": {"type": "Point", "coordinates": [2.5, 1.5]}}]}')
    assert tuple(one(readers.points_geojson(spark, str(tmp_path / "p.geojson")))) == (0, 1.5, 2.5, "a", "b")
    (tmp_path / "s.json").write_text('{"spring": {"start": "2021-03-01", "end": "2021-06-01"}}')
    assert one(readers.seasons(spark, str(tmp_path / "s.json")))["season"] == "spring"
    (tmp_path / "l.json").write_text('{"a": 1, "nodata": 9}')
    assert {r["label"]: r["code"] for r in readers.label_map(spark, str(tmp_path / "l.json"), {"nodata": 0}).collect()} == {"a": 1, "nodata": 0}
    df = spark.createDataFrame([("t1", 1), ("t2", 2)], "tile string, v int")
    sinks.tile_dataset(df, str(tmp_path / "d"))
    sinks.tile_dataset(spark.createDataFrame([("t2", 5)], "tile string, v int"), str(tmp_path / "d"))
    assert {(r["tile"], r["v"]) for r in sinks.merged_dataset(spark, str(tmp_path / "d")).collect()} == {("t1", 1), ("t2", 5)}
    sinks.class_raster(spark.createDataFrame([("t", 0, 0, 7)], "tile string, row int, col int, code int"), str(tmp_path / "c"))
    assert one(readers.classification(spark, str(tmp_path / "c"), "t"))["code"] == 7
    with pytest.raises(Exception):
        sinks.class_raster(spark.createDataFrame([("t", 0, 0, 300)], "tile string, row int, col int, code int"), str(tmp_path / "e"))


def test_kmz(spark, tmp_path):
    import zipfile

    kml = '<kml xmlns="http://www.opengis.net/kml/2.2"><Document><Placemark><name>n</name><description>&lt;td&gt;LC&lt;/td&gt;&lt;td&gt;wood&lt;/td&gt;</description><Point><coordinates>2.5,1.5,0</coordinates></Point></Placemark></Document></kml>'
    with zipfile.ZipFile(tmp_path / "p.kmz", "w") as z:
        z.writestr("doc.kml", kml)
    r = one(readers.placemarks_kmz(spark, str(tmp_path / "p.kmz")).withColumn("m", readers.description_table(F.col("description"))))
    assert (r["lon"], r["lat"], r["m"]) == (2.5, 1.5, {"LC": "wood"})


def test_streaming(spark, tmp_path):
    from pixelframe.streaming import products as stream

    df = spark.sql("SELECT 'T' tile, 'p' || id title, timestamp_ntz'2021-04-01 00:00:00' ts, 0.1D cloud, cast(id AS double) nodata FROM range(5)")
    df.write.parquet(str(tmp_path / "in"))
    seasons = spark.sql("SELECT 'spring' season, timestamp_ntz'2021-03-01 00:00:00' start, timestamp_ntz'2021-06-01 00:00:00' end")
    got = []
    source = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    stream.select_each_batch(source, seasons, 50.0, 2, lambda b, n: got.extend(r["title"] for r in b.collect()), str(tmp_path / "ck")).awaitTermination(60)
    assert sorted(got) == ["p0", "p1"]


def test_empty(spark):
    p = spark.createDataFrame([], "tile string, season string, title string, ts timestamp_ntz, cloud double, nodata double")
    assert products.top_k(products.useful_only(p), 2).count() == 0
    assert products.availability(p).count() == 0
    assert model.confusion(spark.createDataFrame([], "a string, b string"), "a", "b").count() == 0


def test_points_in_file_order(spark, tmp_path):
    from pixelframe.sources import readers

    path = tmp_path / "points.csv"
    path.write_text("latitude;longitude;category\n" + "".join(f"{i}.5;1.0;c{i}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = readers.points_csv(spark, str(path)).orderBy("point_ord").collect()
        assert readers.points_csv(spark, str(path)).rdd.getNumPartitions() >= 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r["lc"] for r in got] == [f"c{i}" for i in range(3000)] and len({r["point_ord"] for r in got}) == 3000


def test_listing_and_sample(spark, tmp_path):
    from pixelframe.sources import readers

    for name in ("tile/a.tif", "tile/b.tif", "other/tile_c.tif"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"x")
    assert sorted(r["path"][-5:] for r in readers.listing(spark, str(tmp_path), "tile").collect()) == ["a.tif", "b.tif"]
    rasters = spark.createDataFrame([("S2A_T30SUF_x", 10, "p/b"), ("S2A_T30SUF_x", 10, "p/a"), ("S2A_T30SUF_x", 20, "p/0")], "title string, res int, path string")
    assert [tuple(r) for r in readers.sample_raster(rasters, "30SUF").collect()] == [("S2A_T30SUF_x", 10, "p/a")]
    with pytest.raises(Exception, match="no 10 m band of tile 30SUG"):
        readers.sample_raster(rasters, "30SUG").collect()


def test_composite_sink(spark, tmp_path):
    from pixelframe.sources import sinks

    path = str(tmp_path)
    blocks = spark.createDataFrame([("t", "s", 1), ("t", "s", 2)], "tile string, season string, v int")
    meta = spark.createDataFrame([("t", "s", "title")], "tile string, season string, title string")
    for _ in range(2):  # a rerun replaces
        sinks.composite(blocks, meta, path)
    assert spark.read.parquet(f"{path}/metadata").count() == 1 and spark.read.parquet(f"{path}/blocks").count() == 2
    sinks.composite(blocks.withColumn("tile", F.lit("u")), meta.withColumn("tile", F.lit("u")), path)
    broken = meta.withColumn("title", F.raise_error(F.lit("broken")).cast("string"))
    with pytest.raises(Exception, match="broken"):
        sinks.composite(blocks, broken, path)
    assert [r["tile"] for r in spark.read.parquet(f"{path}/blocks").select("tile").distinct().collect()] == ["u"]
    assert [r["tile"] for r in spark.read.parquet(f"{path}/metadata").collect()] == ["u"]


def test_reports(spark):
    import json

    from pixelframe.functions import geo
    from pixelframe.operators import products
    from pixelframe.sources import sinks

    tiles = spark.createDataFrame([("b", [[0.0, 1.0], [2.0, 1.0]], "0.25"), ("a", [[0.0, 0.0], [1.0, 0.0]], "1")], "tile string, ring array<array<double>>, nodata_fraction string")
    found = json.loads(sinks.quality_geojson(tiles).first()["geojson"])
    assert found["type"] == "FeatureCollection" and [f["properties"] for f in found["features"]] == [{"tile": "a", "nodata": "1"}, {"tile": "b", "nodata": "0.25"}]
    assert found["features"][1]["geometry"] == {"type": "Polygon", "coordinates": [[[0.0, 1.0], [2.0, 1.0]]]}
    two = spark.createDataFrame([("t", "s", "S2A_MSIL2A_20210401T1_N_R_T30SUF_x"), ("t", "s", "S2A_MSIL2A_20210401T1_N_R_T30SUG_x")], "tile string, season string, title string").withColumn("ts", F.lit("2021-04-01").cast("timestamp_ntz"))
    with pytest.raises(Exception, match="a composite of tiles"):
        products.composite_identity(two).collect()
    kinds = spark.sql("SELECT kind, array(1D, 2D) p, array(array(array(3D, 4D))) poly, array(array(array(array(5D, 6D)))) multi FROM VALUES ('Point'), ('Polygon'), ('MultiPolygon') t(kind)")
    ring = geo.outer_ring(F.col("kind"), F.col("p"), F.col("poly"), F.col("multi"))
    assert [r[0] for r in kinds.select(ring).collect()] == [[[1.0, 2.0]], [[3.0, 4.0]], [[5.0, 6.0]]]
    b = geo.bbox(F.col("ring"))
    box = tiles.where("tile = 'b'").select(*[b[k].alias(k) for k in ("xmin", "ymin", "xmax", "ymax")]).first()
    assert tuple(box) == (0.0, 1.0, 2.0, 1.0)
    around = F.array(F.array(F.lit(-0.1), F.lit(39.9)), F.array(F.lit(0.1), F.lit(40.1)))
    assert set(spark.range(1).select(geo.ring_tiles(around)).first()[0]) >= {"30TYK", "31TBE"}
    corners = geo.raster_corners(F.lit(300000.0), F.lit(4100040.0), F.lit(10.0), F.lit(10980), F.lit(10980), F.lit(30))
    got = spark.range(1).select(corners).first()[0]
    assert len(got) == 5 and got[0] == got[4]
    lat, lon = F.lit(got[2][1]), F.lit(got[2][0])
    east, north = geo.utm(lat, lon, F.lit(30))
    assert spark.range(1).select(F.round(east, 2), F.round(north, 2)).first() == (300000.0 + 109790, 4100040.0 - 109790)
    from pixelframe.operators import raster

    src = spark.sql("SELECT explode(array('dem', 'slope', 'aspect')) k").select(raster.terrain_source(F.col("k")))
    assert [r[0] for r in src.collect()] == ["dem", "derived", "derived"]
    with pytest.raises(Exception, match="unknown terrain layer"):
        spark.range(1).select(raster.terrain_source(F.lit("x"))).collect()
