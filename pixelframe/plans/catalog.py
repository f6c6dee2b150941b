"""Registry of the engine's queries and of the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo, indices, names
from ..operators import features, model, products, raster
from . import proxies as P
from .proxies import GRID, OBS, PRODUCTS, PTS, PX, SEASONAL, SEASONS, with_

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def r6(c):
    return F.round(c, 6)


# ---------------------------------------------------------------- spectral indexes
INDEX_SQL = {
    "moisture": "(B8A-B11)/NULLIF(B8A+B11,0)", "ndvi": "(B08-B04)/NULLIF(B08+B04,0)", "ndwi": "(B03-B08)/NULLIF(B03+B08,0)",
    "ndsi": "CASE WHEN (B03-B11)/NULLIF(B03+B11,0) > 0.42 THEN 1.0 ELSE 0.0 END", "evi2": "2.4::DOUBLE*((B08-B04)/NULLIF(B08+B04+1,0))",
    "osavi": "1.16::DOUBLE*((B08-B04)/NULLIF(B08+B04+0.16::DOUBLE,0))", "ndre": "(B09-B05)/NULLIF(B09+B05,0)", "mndwi": "(B03-B11)/NULLIF(B03+B11,0)",
    "bri": "(1.0::DOUBLE/B03-1.0::DOUBLE/B05)/B08", "evi": "2.5::DOUBLE*((B08-B04)/NULLIF(B08+6*B04-7.5::DOUBLE*B02+1,0))", "ndyi": "(B03-B02)/NULLIF(B03+B02,0)",
    "ri": "(B04-B03)/NULLIF(B04+B03,0)", "cri1": "(1.0::DOUBLE/B02)/NULLIF(1.0::DOUBLE/B03,0)", "bsi": "((B11+B04)-(B08+B02))/NULLIF((B11+B04)+(B08+B02),0)",
}
SCALE = {"bri": 1e6}


def _index(name: str):
    s = SCALE.get(name, 1.0)

    @query(f"idx_{name}", with_(PX) + f"SELECT vec_id, round(({INDEX_SQL[name]}) * {s}::DOUBLE, 6)::DOUBLE AS value FROM pv")
    def run(spark, d):
        return P.px(spark, d).select("vec_id", r6(indices.index(name) * s).alias("value"))


for _name in INDEX_SQL:
    _index(_name)


@query("idx_cloudmask", with_(PX) + "SELECT vec_id, CASE WHEN scl IN (3,8,9,10,11) THEN 1 ELSE 0 END AS mask FROM px")
def _(spark, d):
    return P.px(spark, d).select("vec_id", indices.cloud_mask().alias("mask"))


@query("idx_true_color", with_(PX) + ", t AS (SELECT tile, greatest(max(B04), max(B03), max(B02)) AS top FROM pv GROUP BY tile) SELECT vec_id, CAST(floor(B04*255/top) AS INT) AS red, CAST(floor(B03*255/top) AS INT) AS green, CAST(floor(B02*255/top) AS INT) AS blue FROM pv JOIN t USING (tile)")
def _(spark, d):
    return indices.true_color(P.px(spark, d), ["tile"]).select("vec_id", "red", "green", "blue")


@query("idx_mean", with_(PX) + "SELECT tile, " + ", ".join(f"round(avg({INDEX_SQL[n]}), 6) AS {n}" for n in ("ndvi", "moisture", "ndsi", "osavi", "evi2", "ri")) + " FROM pv GROUP BY tile")
def _(spark, d):
    names_ = ["ndvi", "moisture", "ndsi", "osavi", "evi2", "ri"]
    return indices.index_means(P.px(spark, d), ["tile"], names_).select("tile", *[r6(F.col(n)).alias(n) for n in names_])


@query("normalize", with_(PX) + "SELECT vec_id, round(B08/3500.0::DOUBLE - 1, 6) AS band, round(B04/35.0::DOUBLE - 1, 6) AS slope FROM pv")
def _(spark, d):
    return P.px(spark, d).select("vec_id", r6(raster.normalize(indices.valid("B08"), *raster.RANGES["band"])).alias("band"), r6(raster.normalize(indices.valid("B04"), *raster.RANGES["slope"])).alias("slope"))


# ---------------------------------------------------------------- products
@query("product_match", with_(PRODUCTS) + "SELECT title, tile, ts FROM products WHERE tile = '30SUF' AND ts >= TIMESTAMP '1996-01-01' AND ts < TIMESTAMP '1997-01-01'")
def _(spark, d):
    return products.match(P.products(spark, d), "30SUF", "1996-01-01", "1997-01-01").select("title", "tile", "ts")


def seasonal(spark, d):
    return products.with_useful(products.by_season(P.products(spark, d), P.seasons(spark)))


BASE = with_(PRODUCTS, SEASONS, SEASONAL)


@query("season_interval_join", BASE + "SELECT season, title, ts FROM seasonal")
def _(spark, d):
    return products.by_season(P.products(spark, d), P.seasons(spark)).select("season", "title", "ts")


@query("useful_pixels", with_(PRODUCTS) + "SELECT title, round(100.0::DOUBLE - (cloud * 100.0::DOUBLE + nodata), 6) AS useful FROM products WHERE 100.0::DOUBLE - (cloud * 100.0::DOUBLE + nodata) > 30")
def _(spark, d):
    return products.useful_only(P.products(spark, d), 30.0).select("title", r6(F.col("useful")).alias("useful"))


TOPK = BASE + ", ranked AS (SELECT *, row_number() OVER (PARTITION BY tile, season ORDER BY useful DESC, title) AS rank FROM seasonal WHERE useful > 30) "


@query("useful_topk", TOPK + "SELECT tile, season, title, CAST(rank AS INT) AS rank, round(useful, 6) AS useful FROM ranked WHERE rank <= 3")
def _(spark, d):
    return products.top_k(seasonal(spark, d).where("useful > 30"), 3).select("tile", "season", "title", "rank", r6(F.col("useful")).alias("useful"))


@query("season_complete_semi", BASE + "SELECT tile, season, title FROM seasonal WHERE useful > 75 AND tile IN (SELECT tile FROM seasonal WHERE useful > 75 GROUP BY tile HAVING count(DISTINCT season) = 3)")
def _(spark, d):
    return products.complete_tiles(seasonal(spark, d).where("useful > 75"), 3).select("tile", "season", "title")


@query("integrity_all", "WITH b AS (SELECT l_orderkey AS title, bool_and(l_quantity < 45) AS ok FROM lineitem WHERE l_linenumber <= 4 GROUP BY 1) SELECT o_orderkey AS title FROM orders LEFT JOIN b ON o_orderkey = title WHERE coalesce(ok, TRUE)")
def _(spark, d):
    bands = P.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("title"), (F.col("l_linenumber") <= 4).alias("checked"), (F.col("l_quantity") < 45).alias("ok"))
    return products.intact(P.table(spark, d, "orders").select(F.col("o_orderkey").alias("title")), bands)


@query("composite_hash", TOPK + "SELECT tile, season, sha256(string_agg(title, '' ORDER BY title) || '0') AS hash, min(ts) AS first_date, max(ts) AS last_date FROM ranked WHERE rank <= 3 GROUP BY tile, season")
def _(spark, d):
    top = products.top_k(seasonal(spark, d).where("useful > 30"), 3)
    return products.composite_identity(top).select("tile", "season", "hash", "first_date", "last_date")


@query("composite_title", TOPK + "SELECT tile, season, 'S2S_MSIL2A_' || strftime(min(ts), '%Y%m%d') || '_NXXX_RXXX_T' || tile || '_' || strftime(max(ts), '%Y%m%d') || '_' || substr(sha256(string_agg(title, '' ORDER BY title) || '1'), 1, 8) AS composite_title FROM ranked WHERE rank <= 3 GROUP BY tile, season")
def _(spark, d):
    top = products.top_k(seasonal(spark, d).where("useful > 30"), 3)
    return products.composite_identity(top, training=False).select("tile", "season", "composite_title")


@query("title_parse", with_(PRODUCTS) + "SELECT title, strptime(split_part(title, '_', 3), '%Y%m%dT%H%M%S') AS sensed, split_part(title, '_', 6) AS tile, regexp_matches(title, '^S2[SE]_') AS is_composite, substr(title, 40, 5) AS code FROM products")
def _(spark, d):
    t = F.col("title")
    return P.products(spark, d).select("title", names.title_date(t).alias("sensed"), names.title_tile(t).alias("tile"), names.is_composite(t).alias("is_composite"), F.substring(t, 40, 5).alias("code"))


@query("anti_done", "SELECT DISTINCT CAST(c_nationkey AS INT) AS tile FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 8000)")
def _(spark, d):
    want = P.table(spark, d, "customer").select(F.col("c_nationkey").alias("tile"))
    return products.not_done(want, P.table(spark, d, "supplier").where("s_acctbal > 8000").select(F.col("s_nationkey").alias("tile")))


@query("availability_tiers", BASE + "SELECT tile, season, count(nodata) AS n, CASE WHEN count(nodata) = 0 THEN 0 WHEN count(nodata) = 1 AND max(nodata) > 10 THEN 1 WHEN count(nodata) = 1 THEN 2 WHEN min(nodata) > 10 THEN 3 END AS tier FROM (SELECT tile || '_' || (product_id % 40) AS tile, season, nodata FROM seasonal) GROUP BY tile, season")
def _(spark, d):
    p = seasonal(spark, d).withColumn("tile", F.concat_ws("_", "tile", (F.col("product_id") % 40).cast("string")))
    return products.availability(p).select("tile", "season", "n", "tier")


@query("products_json", TOPK + "SELECT tile, '{' || string_agg('\"' || season || '\":' || m, ',' ORDER BY season) || '}' AS json FROM (SELECT tile, season, '{' || string_agg('\"' || title || '\":' || printf('%.1f', nodata), ',' ORDER BY title) || '}' AS m FROM ranked WHERE rank <= 3 GROUP BY tile, season) GROUP BY tile")
def _(spark, d):
    return products.quality_map(products.top_k(seasonal(spark, d).where("useful > 30"), 3))


@query("product_search", with_(PRODUCTS) + "SELECT title, tile, ts FROM products WHERE starts_with(title, 'S2') AND split_part(title, '_', 2) = 'MSIL2A' AND cloud * 100.0::DOUBLE BETWEEN 0 AND 40 AND ts >= TIMESTAMP '1995-01-01' AND ts < TIMESTAMP '1998-01-01'")
def _(spark, d):
    return products.search(P.products(spark, d), "1995-01-01", "1998-01-01", cloud=(0.0, 40.0)).select("title", "tile", "ts")


@query("product_by_title", with_(PRODUCTS) + "SELECT title, tile, product_id FROM products WHERE product_id % 7 = 0")
def _(spark, d):
    p = P.products(spark, d)
    return products.by_title(p.where("product_id % 7 = 0").select("title"), p).select("title", "tile", "product_id")


@query("composite_lookup", TOPK + "SELECT tile, season, 'S2E_MSIL2A_' || strftime(min(ts), '%Y%m%d') || '_NXXX_RXXX_T' || tile || '_' || strftime(max(ts), '%Y%m%d') || '_' || substr(sha256(string_agg(title, '' ORDER BY title) || '0'), 1, 8) AS composite_title, season = 'spring' AS known FROM ranked WHERE rank <= 3 GROUP BY tile, season")
def _(spark, d):
    made = products.composite_identity(products.top_k(seasonal(spark, d).where("useful > 30"), 3)).select("tile", "season", "composite_title")
    known, missing = products.known_composites(made, made.where("season = 'spring'"))
    return known.withColumn("known", F.lit(True)).unionByName(missing.withColumn("known", F.lit(False)))


@query("union_tiles", "SELECT c_nationkey AS tile FROM customer WHERE c_acctbal > 9000 UNION SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
def _(spark, d):
    return products.all_tiles(P.table(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("tile")), P.table(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("tile")))


@query("skipped_tiles", BASE + ", want AS (SELECT DISTINCT '30SU' || substr('EFGHJKLM', CAST(n_nationkey % 8 + 1 AS INT), 1) AS tile FROM nation), n AS (SELECT tile, count(DISTINCT season) AS n FROM seasonal WHERE useful > 75 AND (season <> 'summer' OR tile <> '30SUF') GROUP BY tile) SELECT tile, CASE WHEN n IS NULL THEN 'no products' ELSE (3 - n) || ' seasons without products' END AS reason FROM want LEFT JOIN n USING (tile) WHERE coalesce(n, 0) < 3")
def _(spark, d):
    want = P.table(spark, d, "nation").select(F.concat(F.lit("30SU"), F.substring(F.lit("EFGHJKLM"), (F.col("n_nationkey") % 8 + 1).cast("int"), F.lit(1))).alias("tile"))
    return products.skipped(want, seasonal(spark, d).where("useful > 75 AND (season <> 'summer' OR tile <> '30SUF')"), 3)


TIER_SQL = "CASE WHEN count(nodata) = 0 THEN 0 WHEN count(nodata) = 1 AND max(nodata) > 10 THEN 1 WHEN count(nodata) = 1 THEN 2 WHEN min(nodata) > 10 THEN 3 END"


@query("availability_log", BASE + f", t AS (SELECT tile, season, {TIER_SQL} AS tier FROM (SELECT tile || '_' || (product_id % 40) AS tile, season, nodata FROM seasonal) GROUP BY tile, season) SELECT tile, season, tier, 'tile=' || tile || ' season=' || season || ' ' || CASE tier WHEN 0 THEN 'no product' WHEN 1 THEN 'one product, not complete' WHEN 2 THEN 'one product, complete' ELSE 'several products, none complete' END AS line FROM t WHERE tier IS NOT NULL")
def _(spark, d):
    return products.availability_log(seasonal(spark, d).withColumn("tile", F.concat_ws("_", "tile", (F.col("product_id") % 40).cast("string"))))


@query("cloud_json", BASE + "SELECT tile, '{' || string_agg('\"' || season || '\":' || m, ',' ORDER BY season) || '}' AS json FROM (SELECT tile, season, '{' || string_agg('\"' || title || '\":' || CAST(cloud AS VARCHAR), ',' ORDER BY title) || '}' AS m FROM seasonal GROUP BY tile, season) GROUP BY tile")
def _(spark, d):
    return products.quality_map(seasonal(spark, d), "cloud")


FILES_SQL = "files AS (SELECT l_orderkey AS title, l_linenumber AS n, CASE l_linenumber WHEN 1 THEN 'p/SCL_20m.jp2' WHEN 2 THEN 'p/SCL_60m.jp2' WHEN 3 THEN 'p/B01_60m.jp2' WHEN 4 THEN 'p/B01_20m.jp2' ELSE 'p/B08_10m.jp2' END AS path, CASE l_linenumber WHEN 1 THEN 20 WHEN 2 THEN 60 WHEN 3 THEN 60 WHEN 4 THEN 20 ELSE 10 END AS res, l_quantity < 45 AS meta_ok, l_discount < 0.1 AS read_ok FROM lineitem)"


@query("integrity_files", with_(FILES_SQL) + ", b AS (SELECT title, bool_and(meta_ok AND read_ok) AS ok FROM files WHERE n <= 4 GROUP BY title) SELECT o_orderkey AS title FROM orders LEFT JOIN b ON o_orderkey = title WHERE coalesce(ok, TRUE)")
def _(spark, d):
    n = F.col("l_linenumber")
    at = lambda *v: F.element_at(F.array(*[F.lit(x) for x in v]), F.least(n, F.lit(5)).cast("int"))
    files = P.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("title"), at("p/SCL_20m.jp2", "p/SCL_60m.jp2", "p/B01_60m.jp2", "p/B01_20m.jp2", "p/B08_10m.jp2").alias("path"), at(20, 60, 60, 20, 10).alias("res"), "l_quantity", "l_discount")
    side = F.element_at(F.create_map(*[F.lit(x) for kv in products.SIDES.items() for x in kv]), F.col("res"))
    files = files.withColumns({"meta_side": F.when(F.col("l_quantity") < 45, side).otherwise(1), "read_side": F.when(F.col("l_discount") < 0.1, side).otherwise(2)})
    return products.intact(P.table(spark, d, "orders").select(F.col("o_orderkey").alias("title")), products.checked_bands(files))


RASTERS = (
    "rasters AS (SELECT l_orderkey AS title, 's' || (l_orderkey % 2) AS season, l_linenumber <= 4 AS is_band, 'p/' || CASE WHEN l_linenumber <= 4 THEN 'B0' || l_linenumber || '_' || CASE l_suppkey % 3 WHEN 0 THEN '10' WHEN 1 THEN '20' ELSE '60' END || 'm.tif' "
    "ELSE CASE l_linenumber WHEN 5 THEN 'ndvi' WHEN 6 THEN 'evi' ELSE 'ri' END || '.tif' END AS path FROM lineitem), named AS (SELECT DISTINCT *, split_part(split_part(split_part(path, '/', 2), '.', 1), '_', 1) AS name FROM rasters)"
)


def rasters(spark, d):
    q = P.table(spark, d, "lineitem")
    n, res = F.col("l_linenumber"), F.when(F.col("l_suppkey") % 3 == 0, "10").when(F.col("l_suppkey") % 3 == 1, "20").otherwise("60")
    path = F.when(n <= 4, F.concat(F.lit("p/B0"), n.cast("string"), F.lit("_"), res, F.lit("m.tif"))).otherwise(F.concat(F.lit("p/"), F.when(n == 5, "ndvi").when(n == 6, "evi").otherwise("ri"), F.lit(".tif")))
    r = q.select(F.col("l_orderkey").alias("title"), F.concat(F.lit("s"), (F.col("l_orderkey") % 2).cast("string")).alias("season"), (n <= 4).alias("is_band"), path.alias("path")).distinct()
    return r.withColumn("name", names.raster_name(F.col("path")))


@query("first_resolution", with_(RASTERS) + "SELECT title, season, name, path FROM (SELECT *, row_number() OVER (PARTITION BY title, season, upper(name) ORDER BY is_band DESC, path) AS n FROM named) WHERE n = 1")
def _(spark, d):
    return products.first_resolution(rasters(spark, d)).select("title", "season", "name", "path")


@query("raster_whitelist", with_(RASTERS) + "SELECT title, season, name, path FROM named WHERE CASE WHEN is_band THEN lower(name) NOT IN ('tci', 'scl') ELSE lower(name) IN ('cri1','ri','evi2','mndwi','moisture','ndyi','ndre','ndvi','osavi') END")
def _(spark, d):
    return products.whitelisted(rasters(spark, d), indices.FEATURE_INDEXES, indices.EXCLUDED_BANDS).select("title", "season", "name", "path")


@query("used_columns", with_(RASTERS) + "SELECT title, season, name, path FROM named WHERE season || '_' || lower(name) IN ('s0_b01', 's1_ndvi', 's1_b03')")
def _(spark, d):
    return products.used_rasters(rasters(spark, d), ["s0_B01", "s1_ndvi", "s1_B03"]).select("title", "season", "name", "path")


@query("band_complete", "WITH own AS (SELECT l_returnflag AS composite, count(DISTINCT l_suppkey) AS k FROM lineitem GROUP BY 1), n AS (SELECT l_returnflag AS composite, l_linenumber AS band, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1, 2) SELECT composite, band FROM n JOIN own USING (composite) WHERE n = k")
def _(spark, d):
    q = P.table(spark, d, "lineitem")
    return raster.complete_bands(q.select(F.col("l_returnflag").alias("composite"), F.col("l_linenumber").alias("band"), F.col("l_suppkey").alias("title")))


@query("raster_enumeration", with_(RASTERS) + "SELECT title, path, is_band FROM named")
def _(spark, d):
    r = rasters(spark, d)
    maps = r.where("NOT is_band").groupBy("title").agg(F.map_from_entries(F.collect_set(F.struct("name", F.struct(F.col("path").alias("rasterS3Key")).alias("r")))).alias("indexes"))
    return products.product_rasters(maps, r.where("is_band"))


@query("index_merge", "SELECT o_orderkey AS title, CASE WHEN o_orderkey % 3 = 0 THEN 'old' ELSE 'new' END AS ndvi, 'new' AS ri FROM orders")
def _(spark, d):
    k = F.col("o_orderkey")
    o = P.table(spark, d, "orders").select(k.alias("title"), F.map_filter(F.create_map(F.lit("ndvi"), F.lit("old")), lambda a, b: k % 3 == 0).alias("indexes"), F.create_map(F.lit("ndvi"), F.lit("new"), F.lit("ri"), F.lit("new")).alias("new_indexes"))
    m = products.merge_indexes()
    return o.select("title", F.element_at(m, "ndvi").alias("ndvi"), F.element_at(m, "ri").alias("ri"))


# ---------------------------------------------------------------- composites and rasters
@query("median_composite", with_(OBS) + "SELECT tile, pixel, round(median(CASE WHEN scl NOT IN (3,8,9,10,11) THEN NULLIF(v, 0) END), 6) AS v FROM obs GROUP BY tile, pixel")
def _(spark, d):
    return raster.composite(P.obs(spark, d), ["tile", "pixel"]).withColumn("v", r6(F.col("v")))


@query("median_composite_blocks", with_(OBS) + "SELECT tile, pixel, round(median(CASE WHEN scl NOT IN (3,8,9,10,11) THEN NULLIF(v, 0) END), 6) AS v FROM (SELECT tile, pixel, product_id % 5 AS product, max(v) AS v, max(scl) AS scl FROM obs GROUP BY 1, 2, 3) GROUP BY tile, pixel")
def _(spark, d):
    one = P.obs(spark, d).groupBy("tile", "pixel", (F.col("product_id") % 5).alias("product")).agg(F.max("v").alias("v"), F.max("scl").alias("scl"))
    cell = F.struct((F.col("pixel") % 64).cast("int").alias("at"), F.when(~indices.is_cloud("scl"), indices.valid("v")).alias("v"))
    blocks = one.select("tile", F.floor(F.col("pixel") / 64).alias("block"), "product", cell.alias("c")).groupBy("tile", "block", "product").agg(F.collect_list("c").alias("c"))
    # 64 cells in order, NULL where the product has no pixel; which cells exist travels along
    data = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.get(F.filter("c", lambda x: x["at"] == i), F.lit(0))["v"])
    have = one.select("tile", "pixel").distinct()
    out = raster.composite_blocks(blocks.select("tile", "block", data.alias("data")), ["tile", "block"])
    out = out.select("tile", "block", F.posexplode("data").alias("at", "v")).select("tile", (F.col("block") * 64 + F.col("at")).alias("pixel"), r6(F.col("v")).alias("v"))
    return out.join(have, ["tile", "pixel"], "left_semi")


@query("flagship_composite_ndvi", with_(PX) + ", c AS (SELECT tile, row, median(B04) AS B04, median(B08) AS B08 FROM (SELECT * FROM pv WHERE scl NOT IN (3,8,9,10,11)) GROUP BY tile, row) SELECT tile, count(*) AS pixels, round(avg((B08-B04)/NULLIF(B08+B04,0)), 6) AS ndvi FROM c GROUP BY tile")
def _(spark, d):
    clear = P.px(spark, d).where(~indices.is_cloud("scl"))
    c = clear.groupBy("tile", "row").agg(*[F.median(indices.valid(b)).alias(b) for b in ("B04", "B08")])
    return c.groupBy("tile").agg(F.count("*").alias("pixels"), r6(F.avg(indices.index("ndvi"))).alias("ndvi"))


def _reflected(axis: str, size: str, src: str, reach: int) -> str:
    other = "col" if axis == "row" else "row"
    return f"(SELECT tile, {axis}, {other}, m FROM {src} UNION ALL SELECT tile, -{axis} - 1, {other}, m FROM {src} WHERE {axis} < {reach} UNION ALL SELECT tile, 2 * {size} - 1 - {axis}, {other}, m FROM {src} WHERE {axis} >= {size} - {reach})"


def _expanded(mask: str, n: int, to: str) -> str:
    """CTEs that widen mask(tile, row, col, m) of 500 x 64 pixels by a box of n x n."""
    low, high = n // 2 - 1, n // 2
    return (
        f"{to}_a AS (SELECT tile, row, col, sum(m) OVER (PARTITION BY tile, col ORDER BY row RANGE BETWEEN {low} PRECEDING AND {high} FOLLOWING) AS m FROM {_reflected('row', '500', mask, high)}), {to}_r AS (SELECT * FROM {to}_a WHERE row BETWEEN 0 AND 499), "
        f"{to}_b AS (SELECT tile, row, col, sum(m) OVER (PARTITION BY tile, row ORDER BY col RANGE BETWEEN {low} PRECEDING AND {high} FOLLOWING) AS m FROM {_reflected('col', '64', f'{to}_r', high)}), "
        f"{to} AS (SELECT tile, row, col, CASE WHEN {to}_b.m >= {n * n * 0.075!r}::DOUBLE THEN 1 ELSE {mask}.m END AS m FROM {mask} JOIN {to}_b USING (tile, row, col))"
    )


MASK = "mask AS (SELECT tile, row, col, CASE WHEN v > 0.25 THEN 1 ELSE 0 END AS m FROM grid)"


def _cloud_expand(name: str, res: int):
    @query(name, with_(GRID, MASK, _expanded("mask", 600 // res, "wide")) + "SELECT tile, row, col, m AS mask FROM wide")
    def run(spark, d):
        mask = P.grid(spark, d).select("tile", "row", "col", F.when(F.col("v") > 0.25, 1).otherwise(0).alias("mask"))
        return raster.expand_mask(mask, ["tile"], 500, 64, res)


for _name, _res in (("cloud_expand", 60), ("cloud_expand_20m", 20), ("cloud_expand_10m", 10)):
    _cloud_expand(_name, _res)


SCL = "scl AS (SELECT tile, row, col, CAST(floor((v + 2) * 7) AS INT) % 12 AS s FROM grid), plain AS (SELECT tile, row, col, CASE WHEN s IN (3,8,9,10,11) THEN 1 ELSE 0 END AS m FROM scl)"


@query(
    "masks_by_resolution",
    with_(GRID, SCL, _expanded("plain", 30, "w20"), _expanded("plain", 10, "w60"))
    + "SELECT tile, 10 AS res, row * 2 + a AS row, col * 2 + b AS col, m AS mask FROM w20, range(2) x(a), range(2) y(b) UNION ALL SELECT tile, 20, row, col, m FROM w20 UNION ALL SELECT tile, 60, row, col, m FROM w60",
)
def _(spark, d):
    scl = P.grid(spark, d).select("tile", F.explode(F.array(F.lit(20), F.lit(60))).alias("res"), "row", "col", (F.floor((F.col("v") + 2.0) * 7.0).cast("int") % 12).alias("scl"))
    return raster.masks_by_resolution(scl, {20: (500, 64), 60: (500, 64)}, keys=("tile",))


@query("resample_nearest", with_(GRID) + "SELECT tile, row * 2 + a AS row, col * 2 + b AS col, round(v, 6) AS v FROM grid, range(2) x(a), range(2) y(b)")
def _(spark, d):
    return raster.upsample(P.grid(spark, d), 2).withColumn("v", r6(F.col("v")))


@query("coarse_join", with_(GRID) + ", f AS MATERIALIZED (SELECT tile, row, col, v, row // 6 AS crow, col // 6 AS ccol FROM grid), c AS MATERIALIZED (SELECT tile, row AS crow, col AS ccol, v AS coarse FROM grid) SELECT tile, row, col, round(v, 6) AS v, round(coarse, 6) AS coarse FROM f JOIN c USING (tile, crow, ccol)")
def _(spark, d):
    g = P.grid(spark, d)
    return raster.coarse_join(g, g.withColumnRenamed("v", "coarse"), 6, ["tile"]).select("tile", "row", "col", r6(F.col("v")).alias("v"), r6(F.col("coarse")).alias("coarse"))


@query("downscale", with_(GRID) + "SELECT tile, row // 6 AS row, col // 6 AS col, round(v, 6) AS v FROM grid WHERE row % 6 = 3 AND col % 6 = 3")
def _(spark, d):
    return raster.downsample(P.grid(spark, d), 6).withColumn("v", r6(F.col("v")))


@query("mosaic_first", with_(GRID) + "SELECT tile, row, col, round(arg_min(v, ord), 6) AS v FROM (SELECT tile, row % 100 AS row, col, row // 100 AS ord, CASE WHEN v > 0 THEN v END AS v FROM grid) WHERE v IS NOT NULL GROUP BY tile, row, col")
def _(spark, d):
    g = P.grid(spark, d).select("tile", (F.col("row") % 100).alias("row"), "col", F.floor(F.col("row") / 100).alias("ord"), F.when(F.col("v") > 0, F.col("v")).alias("v"))
    return raster.mosaic(g, ["tile"]).withColumn("v", r6(F.col("v")))


@query("crop_pad", with_(GRID) + ", s AS (SELECT tile, row - 10 AS row, col - 5 AS col, v FROM grid WHERE row BETWEEN 10 AND 59 AND col BETWEEN 5 AND 44), g AS (SELECT DISTINCT tile, row, col FROM grid) SELECT tile, row, col, round(coalesce(v, 0), 6) AS v FROM g LEFT JOIN s USING (tile, row, col)")
def _(spark, d):
    g = P.grid(spark, d)
    return raster.onto_grid(g.select("tile", "row", "col").distinct(), raster.crop(g, 10, 5, 50, 40), ["tile"], "v", 0.0).withColumn("v", r6(F.col("v")))


@query("reproject_nearest", with_(GRID) + ", g AS MATERIALIZED (SELECT tile, row, col, CAST(floor(row * 0.9::DOUBLE + 2) AS BIGINT) AS srow, CAST(floor(col * 1.1::DOUBLE - 3) AS BIGINT) AS scol FROM grid), s AS MATERIALIZED (SELECT tile, row AS srow, col AS scol, v FROM grid) SELECT tile, row, col, round(v, 6) AS v FROM g LEFT JOIN s USING (tile, srow, scol)")
def _(spark, d):
    g = P.grid(spark, d)
    return raster.reproject(g.select("tile", "row", "col"), g, F.floor(F.col("row") * 0.9 + 2.0), F.floor(F.col("col") * 1.1 - 3.0), ["tile"], "v").withColumn("v", r6(F.col("v")))


@query("geometry_mask", with_(GRID) + "SELECT tile, row, col, CASE WHEN col >= 10 AND col < 9.5::DOUBLE + 0.4::DOUBLE * (row - 20) AND row > 20 AND row <= 120 THEN round(v, 6) END AS v FROM grid")
def _(spark, d):
    ring = F.expr("array(array(9.5D, 20.0D), array(9.5D, 120.0D), array(49.5D, 120.0D))")
    y, x = F.col("row").cast("double"), F.col("col").cast("double")
    return raster.mask_outside(P.grid(spark, d).withColumn("v", r6(F.col("v"))), "v", geo.contains(ring, x, y - 1e-9)).select("tile", "row", "col", "v")


_ACROSS, _DOWN = "OVER (PARTITION BY tile, row ORDER BY col)", "OVER (PARTITION BY tile, col ORDER BY row)"
SLOPE = (
    f"a AS (SELECT tile, row, col, lag(v) {_ACROSS} AS v0, v AS v1, lead(v) {_ACROSS} AS v2 FROM grid), "
    f"w AS (SELECT tile, row, col, {', '.join(f'lag(v{c}) {_DOWN} AS n0{c}, v{c} AS n1{c}, lead(v{c}) {_DOWN} AS n2{c}' for c in range(3))} FROM a), "
    "s AS (SELECT tile, row, col, ((n02 + 2*n12 + n22) - (n00 + 2*n10 + n20)) / 80.0::DOUBLE AS dx, ((n00 + 2*n01 + n02) - (n20 + 2*n21 + n22)) / 80.0::DOUBLE AS dy FROM w), "
    "t AS (SELECT *, degrees(atan2(-dy, -dx)) AS turn FROM s) "
)


@query("slope_aspect", with_(GRID, SLOPE) + "SELECT tile, row, col, round(degrees(atan(sqrt(dx*dx + dy*dy))), 6) AS slope, round(CASE WHEN turn < 0 THEN turn + 360 ELSE turn END, 6) AS aspect FROM t")
def _(spark, d):
    return raster.slope_aspect(P.grid(spark, d), ["tile"], 10.0).select("tile", "row", "col", r6(F.col("slope")).alias("slope"), r6(F.col("aspect")).alias("aspect"))


@query("nodata_pct", with_(PX) + "SELECT tile, round(sum(CASE WHEN B08 = 0 THEN 1 ELSE 0 END) * 100.0 / count(*), 6)::DOUBLE AS nodata_pct FROM px GROUP BY tile")
def _(spark, d):
    return raster.nodata_share(P.px(spark, d), ["tile"], "B08").select("tile", r6(F.col("nodata_pct").cast("double")).alias("nodata_pct"))


@query("classified_share", with_(PX) + ", f AS (SELECT tile, printf('%.2f', sum(CASE WHEN B08 = 0 THEN 1 ELSE 0 END)::DOUBLE / count(*)) AS f FROM px GROUP BY tile) SELECT n_nationkey AS tile, coalesce(f, '1') AS nodata_fraction FROM nation LEFT JOIN f ON n_nationkey = tile")
def _(spark, d):
    return products.classified_share(P.table(spark, d, "nation").select(F.col("n_nationkey").alias("tile")), raster.nodata_share(P.px(spark, d), ["tile"], "B08"))


@query("window_slices", "SELECT s_suppkey AS tile, h // 3 * i AS row0, w // 4 * j AS col0, CASE WHEN i = 2 THEN h - h // 3 * 2 ELSE h // 3 END AS height, CASE WHEN j = 3 THEN w - w // 4 * 3 ELSE w // 4 END AS width FROM (SELECT s_suppkey, 100 + s_suppkey % 50 AS h, 90 + s_suppkey % 7 AS w FROM supplier), range(3) x(i), range(4) y(j)")
def _(spark, d):
    k = F.col("s_suppkey")
    return raster.window_slices(P.table(spark, d, "supplier").select(k.alias("tile"), (100 + k % 50).alias("height"), (90 + k % 7).alias("width")), 3, 4)


CELLS = "cells AS (SELECT CASE WHEN lat < 0 THEN 'S' ELSE 'N' END || lpad(CAST(abs(lat) AS VARCHAR), 2, '0') || CASE WHEN lon < 0 THEN 'W' ELSE 'E' END || lpad(CAST(abs(lon) AS VARCHAR), 3, '0') AS name, lat, lon FROM (SELECT CAST(p_partkey % 30 + 22 AS INT) AS lat, CAST(p_partkey % 57 - 14 AS INT) AS lon FROM part GROUP BY 1, 2))"


def dem_cells(spark, d):
    c = P.table(spark, d, "part").select((F.col("p_partkey") % 30 + 22).cast("int").alias("lat"), (F.col("p_partkey") % 57 - 14).cast("int").alias("lon")).distinct()
    return c.withColumn("name", geo.cell_name(F.col("lat"), F.col("lon")))


@query("gps_parse", with_(CELLS) + "SELECT name, lat, lon FROM cells")
def _(spark, d):
    lat, lon = geo.parse_cell(F.col("name"))
    return dem_cells(spark, d).select("name", lat.alias("lat"), lon.alias("lon"))


@query("dem_overlap", with_(CELLS) + ", tiles AS (SELECT s_suppkey AS tile, 25 + (s_suppkey % 180) / 10.0::DOUBLE AS ymin, -10 + (s_suppkey % 370) / 10.0::DOUBLE AS xmin FROM supplier) SELECT tile, name FROM tiles JOIN cells ON lat < ymin + 1.05::DOUBLE AND lat + 1 > ymin AND lon < xmin + 1.05::DOUBLE AND lon + 1 > xmin")
def _(spark, d):
    k = F.col("s_suppkey")
    t = P.table(spark, d, "supplier").select(k.alias("tile"), (25 + (k % 180) / 10.0).alias("ymin"), (-10 + (k % 370) / 10.0).alias("xmin"))
    return raster.dem_cells_of_tiles(dem_cells(spark, d), t.withColumns({"ymax": F.col("ymin") + 1.05, "xmax": F.col("xmin") + 1.05}))


TERRAIN = (
    "tiles AS (SELECT s_suppkey AS tile, 15 + (s_suppkey % 180) / 5.0::DOUBLE AS ymin, -10 + (s_suppkey % 370) / 10.0::DOUBLE AS xmin FROM supplier), "
    "pairs AS (SELECT tile, name FROM tiles JOIN cells ON lat < ymin + 1.05::DOUBLE AND lat + 1 > ymin AND lon < xmin + 1.05::DOUBLE AND lon + 1 > xmin)"
)


def dem_tiles(spark, d):
    k = F.col("s_suppkey")
    t = P.table(spark, d, "supplier").select(k.alias("tile"), (15 + (k % 180) / 5.0).alias("ymin"), (-10 + (k % 370) / 10.0).alias("xmin"))
    return t.withColumns({"ymax": F.col("ymin") + 1.05, "xmax": F.col("xmin") + 1.05})


@query(
    "dem_terrain",
    with_(CELLS, TERRAIN)
    + ", vals AS (SELECT c.name, p_size % 8 AS row, p_partkey % 8 AS col, max(p_retailprice) AS v FROM part JOIN cells c ON c.lat = p_partkey % 30 + 22 AND c.lon = p_partkey % 57 - 14 GROUP BY 1, 2, 3)"
    + ", first AS (SELECT tile, row, col, arg_min(v, name) AS v FROM pairs JOIN vals USING (name) GROUP BY 1, 2, 3), g AS (SELECT DISTINCT tile, r.r AS row, c.c AS col FROM pairs, range(6) r(r), range(6) c(c))"
    + " SELECT g.tile, g.row, g.col, round(f.v, 6) AS v FROM g LEFT JOIN first f ON f.tile = g.tile AND f.row = CAST(floor(g.row * 1.2::DOUBLE + 0.5) AS BIGINT) AND f.col = CAST(floor(g.col * 1.1::DOUBLE) AS BIGINT)",
)
def _(spark, d):
    part = P.table(spark, d, "part")
    name = geo.cell_name((F.col("p_partkey") % 30 + 22).cast("int"), (F.col("p_partkey") % 57 - 14).cast("int"))
    values = part.groupBy(name.alias("name"), (F.col("p_size") % 8).alias("row"), (F.col("p_partkey") % 8).alias("col")).agg(F.max("p_retailprice").alias("v"))
    tiles = dem_tiles(spark, d)
    side = F.sequence(F.lit(0), F.lit(5))
    grid = tiles.select("tile", F.explode(side).alias("row")).select("tile", "row", F.explode(side).alias("col")).select("tile", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"))
    out = raster.terrain(dem_cells(spark, d), tiles, values, grid, F.floor(F.col("row") * 1.2 + 0.5), F.floor(F.col("col") * 1.1))
    return out.select("tile", "row", "col", r6(F.col("v")).alias("v"))


@query("missing_terrain", with_(CELLS, TERRAIN) + "SELECT tile, 'no elevation cell' AS reason FROM tiles WHERE tile NOT IN (SELECT tile FROM pairs)")
def _(spark, d):
    return raster.missing_terrain(dem_cells(spark, d), dem_tiles(spark, d))


# ---------------------------------------------------------------- geography
def _utm_sql() -> str:
    z = "(CAST(floor((lon + 180) / 6) AS INT) % 60 + 1)"
    a = ", ".join(f"{x!r}::DOUBLE AS al{i}" for i, x in enumerate(geo.ALPHA, 1))
    ecc = f"{geo.ECC!r}::DOUBLE"
    east = "eta + " + " + ".join(f"al{i} * cos({2 * i} * xi) * sinh({2 * i} * eta)" for i in (1, 2, 3))
    north = "xi + " + " + ".join(f"al{i} * sin({2 * i} * xi) * cosh({2 * i} * eta)" for i in (1, 2, 3))
    k = f"{geo.K0 * geo.RADIUS!r}::DOUBLE"
    return (
        f"z AS (SELECT *, {z} AS zone, {a} FROM pts), t AS (SELECT *, sinh(atanh(sin(radians(lat))) - {ecc} * atanh({ecc} * sin(radians(lat)))) AS t, radians(lon - (zone * 6 - 183)) AS lam FROM z), "
        f"u AS (SELECT *, atan2(t, cos(lam)) AS xi, atanh(sin(lam) / sqrt(1 + t * t)) AS eta FROM t), utm AS (SELECT *, 500000 + {k} * ({east}) AS east, {k} * ({north}) AS north FROM u)"
    )


@query("utm_xy", with_(PTS, _utm_sql()) + "SELECT point_ord, zone, round(east, 3) AS east, round(north, 3) AS north FROM utm")
def _(spark, d):
    p = P.pts(spark, d).withColumn("zone", geo.zone(F.col("lat"), F.col("lon")))
    east, north = geo.utm(F.col("lat"), F.col("lon"), F.col("zone"))
    return p.select("point_ord", "zone", F.round(east, 3).alias("east"), F.round(north, 3).alias("north"))


MGRS_SQL = f"lpad(CAST(zone AS VARCHAR), 2, '0') || substr('{geo.BAND_LETTERS}', CAST(floor((lat + 80) / 8) AS INT) + 1, 1) || substr('{geo.COLUMN_LETTERS}', ((zone - 1) % 3) * 8 + CAST(floor(east / 100000) AS INT), 1) || substr('{geo.ROW_LETTERS}', (CAST(floor(north / 100000) AS INT) + CASE WHEN zone % 2 = 0 THEN 5 ELSE 0 END) % 20 + 1, 1)"


@query("mgrs_tile", with_(PTS, _utm_sql()) + f"SELECT point_ord, {MGRS_SQL} AS tile FROM utm")
def _(spark, d):
    return features.assign_tiles(P.pts(spark, d)).select("point_ord", "tile")


@query("tile_points", with_(PTS, _utm_sql()) + f"SELECT {MGRS_SQL} AS tile, lc, count(*) AS n, min(point_ord) AS first_point FROM utm GROUP BY 1, 2")
def _(spark, d):
    return features.assign_tiles(P.pts(spark, d)).groupBy("tile", "lc").agg(F.count("*").alias("n"), F.min("point_ord").alias("first_point"))


@query("utm_round_trip", with_(PTS) + "SELECT point_ord, round(lat, 6) AS lat, round(lon, 6) AS lon FROM pts")
def _(spark, d):
    p = P.pts(spark, d).withColumn("zone", geo.zone(F.col("lat"), F.col("lon")))
    east, north = geo.utm(F.col("lat"), F.col("lon"), F.col("zone"))
    lat, lon = geo.geographic(F.col("e"), F.col("n"), F.col("zone"))
    return p.withColumns({"e": east, "n": north}).select("point_ord", r6(lat).alias("lat"), r6(lon).alias("lon"))


@query("centroid", "SELECT s_suppkey, round(40 + s_suppkey * 0.001::DOUBLE + 1.0::DOUBLE, 6) AS lat, round(-3 + s_suppkey * 0.002::DOUBLE + 2.0::DOUBLE, 6) AS lon FROM supplier")
def _(spark, d):
    x, y = F.lit(-3.0) + F.col("s_suppkey") * 0.002, F.lit(40.0) + F.col("s_suppkey") * 0.001
    ring = F.array(*[F.array(x + a, y + b) for a, b in ((0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (0.0, 2.0))])
    c = P.table(spark, d, "supplier").select("s_suppkey", ring.alias("ring")).select("s_suppkey", geo.centroid(F.col("ring")).alias("c"))
    return c.select("s_suppkey", r6(F.col("c.lat")).alias("lat"), r6(F.col("c.lon")).alias("lon"))


# ---------------------------------------------------------------- labels and features
@query("label_stamp", with_(PTS) + ", q AS (SELECT point_ord, lc, lat, lon, CAST(floor((lat - 36) * 10) AS BIGINT) AS row, CAST(floor((lon + 9) * 10) AS BIGINT) AS col FROM pts), s AS (SELECT point_ord, lc, lat, lon, row + a AS row, col + b AS col FROM q, (VALUES (-1), (0), (1)) x(a), (VALUES (-1), (0), (1)) y(b)) SELECT row, col, arg_max(lc, point_ord) AS lc, round(arg_max(lat, point_ord), 6) AS lat, round(arg_max(lon, point_ord), 6) AS lon FROM s WHERE row >= 0 AND col >= 0 AND row < 70 AND col < 170 GROUP BY row, col")
def _(spark, d):
    p = P.pts(spark, d).withColumns({"tile": F.lit(0), "row": F.floor((F.col("lat") - 36.0) * 10.0), "col": F.floor((F.col("lon") + 9.0) * 10.0)})
    out = features.stamp(p, ["tile"], ["lc", "lat", "lon"], "point_ord", 70, 170)
    return out.select("row", "col", "lc", r6(F.col("lat")).alias("lat"), r6(F.col("lon")).alias("lon"))


@query("label_mask", with_(PX) + "SELECT p.tile, p.row, p.col, l.vec_id IS NULL AS masked FROM px p LEFT JOIN (SELECT * FROM px WHERE lc < 3) l USING (vec_id)")
def _(spark, d):
    p = P.px(spark, d)
    return features.label_mask(p.select("tile", "row", "col"), p.where("lc < 3"), ["tile"]).select("tile", "row", "col", "masked")


@query("feature_zip_join", with_(PX) + "SELECT tile, row, col, round((B08-B04)/NULLIF(B08+B04,0), 6) AS ndvi, round((B03-B02)/NULLIF(B03+B02,0), 6) AS ndyi, lc FROM pv")
def _(spark, d):
    p = P.px(spark, d)
    layers = [p.select("tile", "row", "col", r6(indices.index(n)).alias(n)) for n in ("ndvi", "ndyi")] + [p.select("tile", "row", "col", "lc")]
    return features.assemble(layers, ["tile"])


@query("widen_seasons", with_(GRID) + "SELECT tile, row, col % 16 AS col, " + ", ".join(f"round(max(CASE WHEN col // 16 = {i} THEN v END), 6) AS s{i}_v" for i in range(4)) + " FROM grid GROUP BY 1, 2, 3")
def _(spark, d):
    g = P.grid(spark, d).select("tile", "row", (F.col("col") % 16).alias("col"), F.concat(F.lit("s"), F.floor(F.col("col") / 16).cast("string")).alias("season"), F.lit("v").alias("name"), r6(F.col("v")).alias("v"))
    return features.widen(g, ["tile"], columns=[f"s{i}_v" for i in range(4)])


@query("union_by_name", with_(PX) + "SELECT vec_id, CASE WHEN tile IS DISTINCT FROM 1 THEN B02 END AS B02, CASE WHEN tile IS DISTINCT FROM 0 THEN B03 END AS B03 FROM pv")
def _(spark, d):
    p = P.px(spark, d)
    b02, b03 = (indices.valid(b).alias(b) for b in ("B02", "B03"))
    rest = p.where("coalesce(tile, -1) NOT IN (0, 1)").select("vec_id", b02, b03)
    return features.union_tiles([p.where("tile = 0").select("vec_id", b02), p.where("tile = 1").select("vec_id", b03), rest])


# ---------------------------------------------------------------- split, evaluation, prediction rules
SPLIT = PTS + ", loc AS (SELECT DISTINCT lc, CAST(point_ord % 97 AS INT) AS latitude, CAST(point_ord % 89 AS INT) AS longitude FROM pts), split AS (SELECT lc, latitude, longitude, CASE WHEN row_number() OVER (PARTITION BY lc ORDER BY md5('0|' || lc || '|' || latitude || '|' || longitude), latitude, longitude) <= floor(count(*) OVER (PARTITION BY lc) * 0.85::DOUBLE) THEN 'train' ELSE 'test' END AS part FROM loc)"


def located(spark, d):
    return P.pts(spark, d).select("point_ord", "lc", (F.col("point_ord") % 97).cast("int").alias("latitude"), (F.col("point_ord") % 89).cast("int").alias("longitude"))


@query("group_split", with_(SPLIT) + "SELECT * FROM split")
def _(spark, d):
    return model.location_split(located(spark, d), "lc")


@query("split_backjoin", with_(SPLIT) + "SELECT part, s.lc, count(*) AS n FROM (SELECT CAST(point_ord % 97 AS INT) AS latitude, CAST(point_ord % 89 AS INT) AS longitude FROM pts) p JOIN split s USING (latitude, longitude) GROUP BY part, s.lc")
def _(spark, d):
    p = located(spark, d)
    return model.back_join(p.drop("lc"), model.location_split(p, "lc")).groupBy("part", "lc").agg(F.count("*").alias("n"))


@query("safe_split", with_(SPLIT) + "SELECT latitude, longitude, min(part) AS part FROM split GROUP BY 1, 2")
def _(spark, d):
    return model.safe_split(located(spark, d), "lc")


@query("distinct_locations", with_(PTS) + "SELECT lc, count(*) AS n FROM (SELECT DISTINCT lc, CAST(point_ord % 97 AS INT) AS a, CAST(point_ord % 89 AS INT) AS b FROM pts) GROUP BY lc")
def _(spark, d):
    return located(spark, d).dropDuplicates(["lc", "latitude", "longitude"]).groupBy("lc").agg(F.count("*").alias("n"))


@query("confusion", "SELECT p.l AS pred, a.l AS actual, (SELECT count(*) FROM labels WHERE quality = p.l AND toxic = a.l) AS n FROM (SELECT DISTINCT quality AS l FROM labels UNION SELECT DISTINCT toxic FROM labels) p, (SELECT DISTINCT quality AS l FROM labels UNION SELECT DISTINCT toxic FROM labels) a")
def _(spark, d):
    return model.confusion(P.table(spark, d, "labels"), "quality", "toxic")


@query("confusion_totals", "SELECT quality AS pred, toxic AS actual, count(*) AS n, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM labels), 6) AS pct FROM labels GROUP BY CUBE (quality, toxic)")
def _(spark, d):
    return model.confusion_totals(P.table(spark, d, "labels"), "quality", "toxic").select("pred", "actual", "n", r6(F.col("pct").cast("double")).alias("pct"))


@query("class_accuracy", "SELECT toxic AS actual, count(*) AS n, round(sum(CASE WHEN quality = toxic THEN 1 ELSE 0 END) * 100.0::DOUBLE / count(*), 6) AS ok_pct FROM labels GROUP BY toxic")
def _(spark, d):
    return model.class_accuracy(P.table(spark, d, "labels"), "quality", "toxic").select("actual", "n", r6(F.col("ok_pct").cast("double")).alias("ok_pct"))


CODES_SQL = "CASE lc WHEN 'click' THEN 1 WHEN 'view' THEN 2 WHEN 'purchase' THEN 3 WHEN 'nodata' THEN 0 ELSE 0 END"


@query("label_encode", with_(PTS) + f"SELECT point_ord, {CODES_SQL} AS code FROM pts")
def _(spark, d):
    return P.pts(spark, d).select("point_ord", model.encode(F.col("lc"), P.LC_CODES, {"nodata": 0}).alias("code"))


@query("nodata_precedence", with_(PX) + "SELECT vec_id, CASE WHEN B02 IS NULL OR B08 IS NULL THEN 0 WHEN lc IN (1, 2, 3) THEN lc + 1 ELSE 1 END AS code FROM pv")
def _(spark, d):
    p = P.px(spark, d).withColumns({b: indices.valid(b) for b in ("B02", "B08")})
    routed = F.when(indices.any_missing(["B02", "B08"]), "nodata").when(F.col("lc").isin(1, 2, 3), F.col("lc").cast("string")).otherwise("noclassified")
    return p.select("vec_id", model.encode(routed, {"1": 2, "2": 3, "3": 4}, {"nodata": 0, "noclassified": 1}).alias("code"))


@query("training_rows", with_(PX) + "SELECT vec_id FROM pv WHERE B02 IS NOT NULL AND B03 IS NOT NULL AND B08 IS NOT NULL")
def _(spark, d):
    p = P.px(spark, d).select("vec_id", *[F.when(F.col(b) == 0, float("inf")).otherwise(F.col(b)).alias(b) for b in ("B02", "B03", "B08")])
    return model.clean(p).select("vec_id")


@query("kml_table", "SELECT c_custkey, c_name AS name, c_mktsegment AS segment FROM customer")
def _(spark, d):
    from ..sources.readers import description_table

    html = F.concat(F.lit("<table><tr><td>name</td><td>"), F.col("c_name"), F.lit("</td></tr><tr><td>segment</td><td> "), F.col("c_mktsegment"), F.lit("</td></tr></table>"))
    t = P.table(spark, d, "customer").select("c_custkey", description_table(html).alias("m"))
    return t.select("c_custkey", F.element_at("m", "name").alias("name"), F.element_at("m", "segment").alias("segment"))


@query("output_tile", "SELECT s_suppkey, substr('f/classification_' || lpad(CAST(s_suppkey AS VARCHAR), 5, '0') || '.tif', -9, 5) AS tile FROM supplier")
def _(spark, d):
    path = F.concat(F.lit("f/classification_"), F.lpad(F.col("s_suppkey").cast("string"), 5, "0"), F.lit(".tif"))
    return P.table(spark, d, "supplier").select("s_suppkey", names.output_tile(path).alias("tile"))


# ---------------------------------------------------------------- models (no SQL form)
def _training(spark, d):
    p = P.px(spark, d).select("vec_id", F.concat(F.lit("c"), (F.col("lc") % 3).cast("string")).alias("LC"), F.concat(F.lit("s"), F.col("lc").cast("string")).alias("SL"), *[indices.valid(b).alias(b) for b in ("B02", "B03", "B04", "B08", "B11")])
    return p, ["B02", "B03", "B04", "B08", "B11"]


@query("forest_predict")
def _(spark, d):
    df, used = _training(spark, d)
    fitted = model.fit_forest(model.clean(df), used, "LC", trees=10, depth=6)
    return model.predict(fitted, df, used).select("vec_id", "LC", "predicted")


@query("model_route")
def _(spark, d):
    df, used = _training(spark, d)
    models = model.fit_second_level(model.clean(df), used, trees=5, depth=5)
    return model.route(df.withColumnRenamed("LC", "lc_class"), models, {c: used for c in models}, "lc_class").select("vec_id", "lc_class", "predicted")


@query("feature_elimination")
def _(spark, d):
    df, used = _training(spark, d)
    keep = model.reduce_features(model.clean(df), used, "LC", 60.0)
    return spark.createDataFrame([(c,) for c in keep], "feature string")


@query("pca_columns")
def _(spark, d):
    df, used = _training(spark, d)
    return spark.createDataFrame([(c,) for c in model.pca_features(model.clean(df), used)], "feature string")
