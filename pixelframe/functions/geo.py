"""Map projection, MGRS grid and ring geometry as Column expressions.

Transverse Mercator uses the Krueger series to the third power of the third flattening
(millimetres inside a zone), on the WGS84 ellipsoid.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

A, FLAT, K0, EAST = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0
N = FLAT / (2 - FLAT)
RADIUS = A / (1 + N) * (1 + N**2 / 4 + N**4 / 64)
ALPHA = (N / 2 - 2 * N**2 / 3 + 5 * N**3 / 16, 13 * N**2 / 48 - 3 * N**3 / 5, 61 * N**3 / 240)
BETA = (N / 2 - 2 * N**2 / 3 + 37 * N**3 / 96, N**2 / 48 + N**3 / 15, 17 * N**3 / 480)
DELTA = (2 * N - 2 * N**2 / 3 - 2 * N**3, 7 * N**2 / 3 - 8 * N**3 / 5, 56 * N**3 / 15)
ECC = 2 * math.sqrt(N) / (1 + N)

BAND_LETTERS = "CDEFGHJKLMNPQRSTUVWX"
COLUMN_LETTERS = "ABCDEFGHJKLMNPQRSTUVWXYZ"
ROW_LETTERS = "ABCDEFGHJKLMNPQRSTUV"


def zone(lat: Column, lon: Column) -> Column:
    """UTM zone, with the exceptions of south-west Norway and Svalbard."""
    plain = (F.pmod(F.floor((lon + 180.0) / 6.0), F.lit(60)) + 1).cast("int")
    north = (lat >= 72) & (lat < 84) & (lon >= 0) & (lon < 42)
    svalbard = F.when(lon < 9, 31).when(lon < 21, 33).when(lon < 33, 35).otherwise(37)
    return F.when((lat >= 56) & (lat < 64) & (lon >= 3) & (lon < 12), 32).when(north, svalbard).otherwise(plain)


def utm(lat: Column, lon: Column, z: Column) -> tuple[Column, Column]:
    """Easting and northing in zone z; southern northings have 10,000 km added."""
    phi, lam = F.radians(lat), F.radians(lon - (z * 6.0 - 183.0))
    t = F.sinh(F.atanh(F.sin(phi)) - ECC * F.atanh(ECC * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1.0 + t * t))
    east, north = eta, xi
    for j, a in enumerate(ALPHA, 1):
        east = east + a * F.cos(2.0 * j * xi) * F.sinh(2.0 * j * eta)
        north = north + a * F.sin(2.0 * j * xi) * F.cosh(2.0 * j * eta)
    return EAST + K0 * RADIUS * east, K0 * RADIUS * north + F.when(lat < 0, 1e7).otherwise(0.0)


def geographic(east: Column, north: Column, z: Column, south: Column | None = None) -> tuple[Column, Column]:
    """Latitude and longitude in degrees of a projected position."""
    shift = F.lit(0.0) if south is None else F.when(south, 1e7).otherwise(0.0)
    xi, eta = (north - shift) / (K0 * RADIUS), (east - EAST) / (K0 * RADIUS)
    x, y = xi, eta
    for j, b in enumerate(BETA, 1):
        x = x - b * F.sin(2.0 * j * xi) * F.cosh(2.0 * j * eta)
        y = y - b * F.cos(2.0 * j * xi) * F.sinh(2.0 * j * eta)
    chi = F.asin(F.sin(x) / F.cosh(y))
    phi = chi
    for j, d in enumerate(DELTA, 1):
        phi = phi + d * F.sin(2.0 * j * chi)
    return F.degrees(phi), z * 6.0 - 183.0 + F.degrees(F.atan2(F.sinh(y), F.cos(x)))


def letter(letters: str, at: Column) -> Column:
    return F.substring(F.lit(letters), at.cast("int"), F.lit(1))


def mgrs_tile(lat: Column, lon: Column) -> Column:
    """The 100 km square, such as 30SUF; NULL beyond 80 S and 84 N."""
    z = zone(lat, lon)
    east, north = utm(lat, lon, z)
    band = letter(BAND_LETTERS, F.least(F.floor((lat + 80.0) / 8.0), F.lit(19)) + 1)
    col = letter(COLUMN_LETTERS, F.pmod(z - 1, F.lit(3)) * 8 + F.floor(east / 1e5))
    row = letter(ROW_LETTERS, F.pmod(F.floor(north / 1e5) + F.when(z % 2 == 0, 5).otherwise(0), F.lit(20)) + 1)
    name = F.concat(F.format_string("%02d", z), band, col, row)
    return F.when((lat >= -80) & (lat <= 84), name)


def pixel(x: Column, y: Column, x0: Column | float, y0: Column | float, res: float) -> tuple[Column, Column]:
    """Row and column of a projected position in a north-up grid."""
    return F.floor((y0 - y) / res).cast("long"), F.floor((x - x0) / res).cast("long")


def pixel_center(row: Column, col: Column, x0: float, y0: float, res: float) -> tuple[Column, Column]:
    return x0 + (col + 0.5) * res, y0 - (row + 0.5) * res


def bbox(ring: Column) -> dict[str, Column]:
    """Bounds of a ring, an array of [x, y] arrays."""
    xs, ys = F.transform(ring, lambda p: p[0]), F.transform(ring, lambda p: p[1])
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def bbox_corners(ring: Column) -> Column:
    b = bbox(ring)
    corner = lambda x, y: F.struct(b[x].alias("lon"), b[y].alias("lat"))
    return F.array(corner("xmin", "ymin"), corner("xmin", "ymax"), corner("xmax", "ymin"), corner("xmax", "ymax"))


def ring_tiles(ring: Column) -> Column:
    """The distinct tiles of a ring's bounding-box corners (one to four)."""
    return F.array_distinct(F.transform(bbox_corners(ring), lambda p: mgrs_tile(p["lat"], p["lon"])))


def edges(ring: Column) -> Column:
    n = F.size(ring)
    return F.zip_with(ring, F.concat(F.slice(ring, F.lit(2), F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def centroid(ring: Column) -> Column:
    """Area centroid (lat, lon) of a ring, open or closed; NULL if its area is 0."""
    e = edges(ring)
    cross = lambda s: s["a"][0] * s["b"][1] - s["b"][0] * s["a"][1]
    area = F.aggregate(e, F.lit(0.0), lambda acc, s: acc + cross(s)) / 2.0
    part = lambda i: F.aggregate(e, F.lit(0.0), lambda acc, s: acc + (s["a"][i] + s["b"][i]) * cross(s))
    return F.struct(F.try_divide(part(1), 6.0 * area).alias("lat"), F.try_divide(part(0), 6.0 * area).alias("lon"))


def drop_z(ring: Column) -> Column:
    return F.transform(ring, lambda p: F.slice(p, 1, 2))


def contains(ring: Column, x: Column, y: Column) -> Column:
    """Whether a ring contains the point (even-odd rule)."""
    crossed = F.filter(edges(ring), lambda s: ((s["a"][1] > y) != (s["b"][1] > y)) & (x < (s["b"][0] - s["a"][0]) * F.try_divide(y - s["a"][1], s["b"][1] - s["a"][1]) + s["a"][0]))
    return F.size(crossed) % 2 == 1


def line_y(x: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """The height at x of the line through two points (NULL if it is vertical)."""
    return y1 + F.try_divide((y2 - y1) * (x - x1), x2 - x1)


def line_x(y: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return x1 + F.try_divide((x2 - x1) * (y - y1), y2 - y1)


def parse_cell(name: Column) -> tuple[Column, Column]:
    """Latitude and longitude of a cell name such as N22E037; S and W are negative."""
    signed = lambda mark, value: F.when(F.regexp_extract(name, "([NS])(\\d+)([EW])(\\d+)", mark).isin("S", "W"), -value).otherwise(value)
    part = lambda i: F.nullif(F.regexp_extract(name, "([NS])(\\d+)([EW])(\\d+)", i), F.lit("")).cast("int")
    return signed(1, part(2)), signed(3, part(4))


def cell_name(lat: Column, lon: Column) -> Column:
    return F.format_string("%s%02d%s%03d", F.when(lat < 0, "S").otherwise("N"), F.abs(lat).cast("int"), F.when(lon < 0, "W").otherwise("E"), F.abs(lon).cast("int"))


def outer_ring(kind: Column, point: Column, polygon: Column, multi: Column) -> Column:
    """The ring that bounds a geometry: of a point the point itself, of a polygon its outer
    ring, of several polygons that of the first."""
    return F.when(kind == "Point", F.array(point)).when(kind == "Polygon", polygon[0]).when(kind == "MultiPolygon", multi[0][0])


def raster_corners(x0: Column, y0: Column, res: Column, height: Column, width: Column, zone: Column) -> Column:
    """Latitude and longitude of a raster's corner pixels, as a closed ring of [lon, lat]."""
    def at(row, col):
        lat, lon = geographic(x0 + col * res, y0 - row * res, zone)
        return F.array(lon, lat)

    first, h, w = F.lit(0), height - 1, width - 1
    return F.array(at(first, first), at(first, w), at(h, w), at(h, first), at(first, first))
