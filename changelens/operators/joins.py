"""Join-side helpers.

``small`` broadcasts a side only after checking that it is small: the row
count of a dictionary-like input is one cheap action, and past the bound
the side is returned unchanged so the join falls back to a shuffle join
(with AQE skew handling).  Sides that are *results* of aggregations are not
hinted at all: AQE sees their materialised size and broadcasts them itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def small(df: DataFrame, max_rows: int) -> DataFrame:
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
