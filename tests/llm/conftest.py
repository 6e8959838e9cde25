import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def frame(spark, rows):
    """Documents from (doc_id, text, lang, source), with further columns whose names clash with inner ones."""
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SCHEMA)
    from pyspark.sql import functions as F

    clashing = ("h", "norm", "size", "rank", "fp", "kept", "keep_id", "copies", "_h", "_copies", "_hash", "_range",
                "component_id", "id", "n", "p", "up", "shard", "text_hash", "held_out", "ids", "quality", "_on_doc_id")
    return df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(clashing)])


LONG = " ".join(f"word{i % 977}x{i}" for i in range(60_000))

#: Nulls, empty and blank texts, ties, repeated rows, a very long text.
ODD = [
    (0, "The quick brown fox jumps over the lazy dog", "en", "a"),
    (1, "the QUICK brown fox jumps over the lazy dog", "en", "b"),
    (2, None, "en", "a"),
    (3, "", None, None),
    (4, " \t\n\x0b\f\r", "de", "a"),
    (None, "no id here, some words", "en", "a"),
    (None, None, None, None),
    (7, LONG, "en", "c"),
    (8, "É x y", "fr", "a"),
    (9, "é x y", "fr", None),
    (10, "twice", "en", "a"),
    (10, "twice", "en", "a"),
    (11, "x", None, "b"),
    (12, "  two   words \n", "en", "b"),
]


@pytest.fixture(scope="session")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="session")
def empty(spark):
    return frame(spark, []).limit(0)
