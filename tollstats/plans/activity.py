"""Which stations were active, kept as bitmaps beside the two tables.

Each load adds the bitmaps of its own records; counts of distinct stations then
come from these few rows and read neither the fact nor the dimension.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tollstats.operators.bitmaps import bitmap_distinct, id_bitmaps
from tollstats.operators.joins import broadcast_if_small
from tollstats.schema import ACTIVITY_KEYS, Tables


def station_activity(tables: Tables) -> DataFrame:
    """Stations with records, by year and administration: anio, administracion, bucket, bitmap."""
    active = tables.flujo_peaje.select("anio", "id_peaje").distinct()
    joined = active.join(broadcast_if_small(tables.peaje), "id_peaje")
    return id_bitmaps(joined, ACTIVITY_KEYS, "id_peaje")


def stations_per_year(activity: DataFrame) -> DataFrame:
    """q10, and the long form of q4, from the activity of any number of loads."""
    counts = bitmap_distinct(activity, ACTIVITY_KEYS, "num_peajes")
    return counts.orderBy(*ACTIVITY_KEYS)


def stations_by(activity: DataFrame, key: str) -> DataFrame:
    """Distinct stations by year or by administration alone: the same bitmaps, merged further."""
    return bitmap_distinct(activity, [key], "num_peajes").orderBy(key)
