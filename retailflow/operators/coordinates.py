"""Insert-if-absent load of the city coordinates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

KEY = ["city", "state"]


def new_coordinates(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows to insert: the first of each (city, state) in the file that is not stored yet."""
    first = incoming.groupBy(*KEY).agg(
        F.min(F.struct("line", "latitude", "longitude")).alias("_first")
    )
    return first.select(*KEY, "_first.latitude", "_first.longitude").join(
        stored.select(*KEY), KEY, "left_anti"
    )
