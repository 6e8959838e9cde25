"""changelens: find and rank meaningful changes in captured web pages, on Spark.

Subpackages
-----------
sources    table readers (driver tables, fixture views), result sinks
functions  Column builders: URLs, text normalisation, status, redirects, formats
operators  DataFrame -> DataFrame steps: version selection, diffs, terms,
           links and blocks, priority, deep search, sheets
plans      end-to-end jobs (weekly sheets, status sheet, re-sheet) and the
           query registry used by ``__spark_entry__``
streaming  Structured Streaming capture feeds
"""

__all__ = ["session"]
