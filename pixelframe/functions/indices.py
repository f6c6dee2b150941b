"""Spectral indexes as a registry of Column factories (nodata is NULL everywhere)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLOUD_CLASSES = (3, 8, 9, 10, 11)  # scene classes: shadow, medium and high cloud, cirrus, snow


def valid(band: str | Column) -> Column:
    """A digital number as double; 0 (nodata), infinities and NaN become NULL."""
    c = (F.col(band) if isinstance(band, str) else band).cast("double")
    return F.when((c != 0) & ~F.isnan(c) & (F.abs(c) != float("inf")), c)


def ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a, b)


def difference(a: Column, b: Column) -> Column:
    """Normalised difference."""
    return ratio(a - b, a + b)


def is_cloud(scl: str | Column) -> Column:
    return (F.col(scl) if isinstance(scl, str) else scl).isin(*CLOUD_CLASSES)


def snow(b3: Column, b11: Column) -> Column:
    """1 where the snow difference exceeds 0.42, else 0: nodata gives 0."""
    return F.when(difference(b3, b11) > 0.42, 1.0).otherwise(0.0)


Formula = Callable[..., Column]
INDEXES: dict[str, tuple[tuple[str, ...], Formula]] = {
    "moisture": (("B8A", "B11"), difference),
    "ndvi": (("B08", "B04"), difference),
    "ndsi": (("B03", "B11"), snow),
    "ndwi": (("B03", "B08"), difference),
    "evi2": (("B08", "B04"), lambda b8, b4: 2.4 * ratio(b8 - b4, b8 + b4 + 1.0)),
    "osavi": (("B08", "B04"), lambda b8, b4: 1.16 * ratio(b8 - b4, b8 + b4 + 0.16)),
    "ndre": (("B09", "B05"), difference),
    "mndwi": (("B03", "B11"), difference),
    "bri": (("B03", "B05", "B08"), lambda b3, b5, b8: ratio(ratio(F.lit(1.0), b3) - ratio(F.lit(1.0), b5), b8)),
    "evi": (("B02", "B04", "B08"), lambda b2, b4, b8: 2.5 * ratio(b8 - b4, b8 + 6.0 * b4 - 7.5 * b2 + 1.0)),
    "ndyi": (("B03", "B02"), difference),
    "ri": (("B04", "B03"), difference),
    "cri1": (("B02", "B03"), lambda b2, b3: ratio(ratio(F.lit(1.0), b2), ratio(F.lit(1.0), b3))),
    "bsi": (("B02", "B04", "B08", "B11"), lambda b2, b4, b8, b11: ratio((b11 + b4) - (b8 + b2), (b11 + b4) + (b8 + b2))),
}
#: Indexes used as model features; the others are made for inspection.
FEATURE_INDEXES = ("cri1", "ri", "evi2", "mndwi", "moisture", "ndyi", "ndre", "ndvi", "osavi")
EXCLUDED_BANDS = ("tci", "scl")


def index(name: str, prefix: str = "") -> Column:
    """The index over band columns named prefix + band."""
    bands, formula = INDEXES[name]
    return formula(*[valid(prefix + b) for b in bands])


def register(name: str, bands: tuple[str, ...], formula: Formula) -> None:
    INDEXES[name] = (bands, formula)


def with_indexes(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    return df.withColumns({n: index(n) for n in names or INDEXES})


def cloud_mask(scl: str = "scl") -> Column:
    return F.when(is_cloud(scl), 1).otherwise(0)


def true_color(df: DataFrame, keys: list[str], red: str = "B04", green: str = "B03", blue: str = "B02") -> DataFrame:
    """uint8 of each channel scaled by the largest value of the three bands of its group
    (NULL is left out of that maximum and stays NULL)."""
    bands = {"red": red, "green": green, "blue": blue}
    top = df.groupBy(*keys).agg(F.greatest(*[F.max(valid(b)) for b in bands.values()]).alias("_top"))
    out = df.join(top, keys)
    return out.withColumns({n: F.floor(ratio(valid(b) * 255.0, F.col("_top"))).cast("int") for n, b in bands.items()}).drop("_top")


def index_means(df: DataFrame, keys: list[str], names: list[str] | None = None) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.avg(index(n)).alias(n) for n in names or INDEXES])


def any_missing(columns: list[str]) -> Column:
    """Whether a feature is missing (NULL, NaN or infinite)."""
    return reduce(lambda a, b: a | b, [F.col(c).isNull() | F.isnan(F.col(c).cast("double")) | (F.abs(F.col(c).cast("double")) == float("inf")) for c in columns], F.lit(False))
