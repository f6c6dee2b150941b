"""Product titles, raster paths and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def raster_name(path: Column) -> Column:
    """The file's stem up to the first underscore: B02_10m.tif and ndvi.tif give B02 and ndvi."""
    return F.substring_index(F.substring_index(file_name(path), ".", 1), "_", 1)


def resolution(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, "_(\\d+)m", 1), F.lit("")).cast("int")


def title_date(title: Column) -> Column:
    return F.to_timestamp_ntz(F.split(title, "_")[2], F.lit("yyyyMMdd'T'HHmmss"))


def title_tile(title: Column) -> Column:
    """The tile with its leading T."""
    return F.split(title, "_")[5]


def is_composite(title: Column) -> Column:
    return title.rlike("^S2[SE]_")


def composite_title(first: Column, last: Column, tile: Column, digest: Column, training: bool) -> Column:
    """S2E_ (training) or S2S_ (prediction) title from date tokens, T-tile and identity hash."""
    return F.concat_ws("_", F.lit("S2E" if training else "S2S"), F.lit("MSIL2A"), F.substring(first, 1, 8), F.lit("NXXX"), F.lit("RXXX"), tile, F.substring(last, 1, 8), F.substring(digest, 1, 8))


def composite_folder(tile: Column, ts: Column) -> Column:
    return F.concat_ws("/", tile, F.date_format(ts, "yyyy"), F.date_format(ts, "MMMM"), F.lit("composites"))


def output_tile(path: Column) -> Column:
    """The five characters before a four-character extension."""
    return F.substring(path, -9, 5)
