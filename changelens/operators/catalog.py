"""The page catalogue's filters (SRC-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def select_pages(pages: DataFrame, url_pattern: str | None = None, tags: list[str] | None = None) -> DataFrame:
    """Active pages whose URL matches ``url_pattern`` (``*`` stands for any
    text) and that carry one of ``tags``; a table without ``active`` is all active."""
    out = pages.where("active") if "active" in pages.columns else pages
    if url_pattern and url_pattern != "*":
        like = url_pattern.replace("\\", "\\\\").replace("%", r"\%").replace("_", r"\_").replace("*", "%")
        out = out.where(F.col("url").like(like))
    if tags:
        out = out.where(F.arrays_overlap("tags", F.array(*[F.lit(t) for t in tags])))
    return out
