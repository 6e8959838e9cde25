"""Where bodies come from: a table, or a function that looks wanted ones up."""

from __future__ import annotations

from pyspark.sql import DataFrame


def bodies_of(bodies, wanted: DataFrame, body_key: str) -> DataFrame:
    """The body table, or the bodies of ``wanted`` (rows of one reference) from a
    function that looks them up: a view that builds bodies from other tables
    then builds those alone instead of all that the join would drop."""
    return bodies(wanted.toDF(body_key)) if callable(bodies) else bodies
