"""Every query with a SQL form, against DuckDB on the same tables."""

import glob
import math
import os

import duckdb
import pytest

from pixelframe.plans.catalog import ORACLE_SQL, QUERIES
from pixelframe.plans.proxies import GRID, PX

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for p in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def rows(found):
    plain = [tuple(round(v, 5) if isinstance(v, float) else v for v in r) for r in found]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    assert names == sorted(con.sql(ORACLE_SQL[name]).columns)
    cols = ", ".join(f'"{c}"' for c in names)
    assert rows(map(tuple, df.select(names).collect())) == rows(con.sql(f"SELECT {cols} FROM ({ORACLE_SQL[name]})").fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_resample_nearest_whole_grid(spark, con):
    # The query's SQL has only rows under 100; every cell is asked for here.
    got = QUERIES["resample_nearest"](spark, SF).select("tile", "row", "col", "v").collect()
    want = con.sql(f"WITH {GRID} SELECT tile, row * 2 + a, col * 2 + b, round(v, 6) FROM grid, range(2) x(a), range(2) y(b)").fetchall()
    assert len(got) == 500 * 64 * 4 and rows(map(tuple, got)) == rows(want)


# The SQL texts of these queries have only the first rows of each tile.
WHOLE = {
    "crop_pad": "s AS (SELECT tile, row - 10 AS row, col - 5 AS col, v FROM grid WHERE row BETWEEN 10 AND 59 AND col BETWEEN 5 AND 44) SELECT tile, row, col, round(coalesce(s.v, 0), 6) FROM grid LEFT JOIN s USING (tile, row, col)",
    "geometry_mask": "one AS (SELECT 1) SELECT tile, row, col, CASE WHEN col >= 10 AND col < 9.5::DOUBLE + 0.4::DOUBLE * (row - 20) AND row > 20 AND row <= 120 THEN round(v, 6) END FROM grid",
    "widen_seasons": "one AS (SELECT 1) SELECT tile, row, col % 16, " + ", ".join(f"round(max(CASE WHEN col // 16 = {i} THEN v END), 6)" for i in range(4)) + " FROM grid GROUP BY 1, 2, 3",
}


@pytest.mark.parametrize("name", sorted(WHOLE))
def test_whole_grid(spark, con, name):
    got = QUERIES[name](spark, SF)
    keys = ["tile", "row", "col"]
    found = got.select(*keys, *sorted(set(got.columns) - set(keys))).collect()
    assert rows(map(tuple, found)) == rows(con.sql(f"WITH {GRID}, {WHOLE[name]}").fetchall())


def test_slope_aspect_whole_grid(spark, con):
    got = {r[:3]: r[3:] for r in map(tuple, QUERIES["slope_aspect"](spark, SF).select("tile", "row", "col", "slope", "aspect").collect())}
    v = {r[:3]: r[3] for r in con.sql(f"WITH {GRID} SELECT tile, row, col, v FROM grid").fetchall()}
    assert len(got) == len(v) == 500 * 64
    for (t, r, c), (slope, aspect) in got.items():
        n = {(i, j): v.get((t, r + i, c + j)) for i in (-1, 0, 1) for j in (-1, 0, 1)}
        if None in n.values():
            assert slope is None and aspect is None
            continue
        dx = ((n[-1, 1] + 2 * n[0, 1] + n[1, 1]) - (n[-1, -1] + 2 * n[0, -1] + n[1, -1])) / 80
        dy = ((n[-1, -1] + 2 * n[-1, 0] + n[-1, 1]) - (n[1, -1] + 2 * n[1, 0] + n[1, 1])) / 80
        assert slope == pytest.approx(math.degrees(math.atan(math.hypot(dx, dy))), abs=2e-6)
        assert aspect == pytest.approx(math.degrees(math.atan2(-dy, -dx)) % 360, abs=2e-6)


def test_band_complete_own_products(spark, con, tmp_path):
    got = QUERIES["band_complete"](spark, SF).select("composite", "band").collect()
    want = "WITH k AS (SELECT l_returnflag, count(DISTINCT l_suppkey) AS k FROM lineitem GROUP BY 1) SELECT l_returnflag, l_linenumber FROM lineitem JOIN k USING (l_returnflag) GROUP BY 1, 2, k HAVING count(DISTINCT l_suppkey) = k"
    assert rows(map(tuple, got)) == rows(con.sql(want).fetchall())
    # Supplier 41 has band 1 only: band 2 is not complete. Composite R has products of its own.
    listing = [("A", b, s) for s in range(1, 41) for b in (1, 2)] + [("A", 1, 41), ("R", 1, 50), ("R", 2, 50), ("R", 2, 51)]
    spark.createDataFrame(listing, "l_returnflag string, l_linenumber int, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert sorted(map(tuple, QUERIES["band_complete"](spark, str(tmp_path)).collect())) == [("A", 1), ("R", 2)]


def test_union_by_name_all_tiles(spark, con):
    got = QUERIES["union_by_name"](spark, SF).select("vec_id", "B02", "B03").collect()
    want = con.sql(f"WITH {PX} SELECT vec_id, CASE WHEN tile <> 1 THEN B02 END, CASE WHEN tile <> 0 THEN B03 END FROM pv").fetchall()
    assert len(got) == 500 and rows(map(tuple, got)) == rows(want)
