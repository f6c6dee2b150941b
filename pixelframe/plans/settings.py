"""Settings of a run, from arguments or environment variables, and areas of interest."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields
from enum import Enum

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geo
from ..operators.products import SIDES


class Mode(Enum):
    TRAINING = "training"
    LAND_COVER_PREDICTION = "land cover"
    SECOND_LEVEL_PREDICTION = "second level"


@dataclass
class Settings:
    base_path: str = "."
    lc_property: str = "LC"
    sl_property: str = "SL"
    min_useful: float = 0.0
    max_products: int = 1
    resolution: int = 10
    cloud_side: float = 600.0
    cloud_share: float = 0.075
    train_fraction: float = 0.85
    second_fraction: float = 0.80
    lc_codes: dict[str, int] = field(default_factory=dict)
    sl_codes: dict[str, int] = field(default_factory=dict)

    tiles: list[str] = field(default_factory=list)
    sides: dict[int, int] = field(default_factory=lambda: dict(SIDES))

    @classmethod
    def from_environment(cls, prefix: str = "PIXELFRAME_") -> Settings:
        """Plain values as they are, lists and maps as JSON."""
        out = cls()
        for f in fields(cls):
            value = os.environ.get(prefix + f.name.upper())
            if value is None:
                continue
            old = getattr(out, f.name)
            if not isinstance(old, (list, dict)):
                setattr(out, f.name, type(old)(value))
                continue
            try:
                made = json.loads(value)
            except ValueError as e:
                raise ValueError(f"{prefix}{f.name.upper()} is no JSON: {e}") from None
            if type(made) is not type(old):
                raise ValueError(f"{prefix}{f.name.upper()} must be a JSON {'list' if isinstance(old, list) else 'object'}")
            setattr(out, f.name, made)
        return out


def tiles_of_area(spark: SparkSession, south: float, north: float, west: float, east: float, step: float = 0.25) -> DataFrame:
    """The 100 km squares that a latitude-longitude box touches, found on a grid of `step`
    degrees that also has the far edges and both sides of every seam of zones (6 degrees of
    longitude) and bands (8 degrees of latitude)."""

    def places(low: float, high: float, seam: float) -> list[float]:
        regular = [low + i * step for i in range(int((high - low) / step) + 1)]
        seams = [s * seam for s in range(int(low // seam), int(high // seam) + 2)]
        return sorted({*regular, high, *(x for s in seams for x in (s - 1e-6, s + 1e-6) if low <= x <= high)})

    lat = spark.createDataFrame([(x,) for x in places(south, north, 8.0)], "lat double")
    lons = F.array(*[F.lit(x) for x in places(west, east, 6.0)])
    return lat.select("lat", F.explode(lons).alias("lon")).select(geo.mgrs_tile(F.col("lat"), F.col("lon")).alias("tile")).where("tile IS NOT NULL").distinct()
