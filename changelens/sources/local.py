"""Small caller-supplied tables (dictionaries, rules) as JVM-side relations.

``spark.createDataFrame`` on a Python list goes through Python workers on
every scan; an inline ``VALUES`` relation stays in the JVM and is planned as
a local relation that broadcasts for free.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, (int, float)):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def values_table(spark: SparkSession, rows: list, columns: list[str], types: list[str] | None = None) -> DataFrame:
    rows = [r if isinstance(r, (tuple, list)) else (r,) for r in rows]
    body = ", ".join("(" + ", ".join(_lit(v) for v in r) + ")" for r in rows)
    df = spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")
    if types:
        df = df.selectExpr(*[f"CAST({c} AS {t}) AS {c}" for c, t in zip(columns, types)])
    return df
