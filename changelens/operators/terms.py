"""Key terms: word streams, stop-word segments, changed n-grams, net counts
(TRM-01..07).

Each side of a pair is a word stream: side ``a`` = unchanged + removed
units, side ``b`` = unchanged + added units (exactly the labelled units of
that side).  The words of changed units are compared a second time: the k-th
occurrence of a word among them on one side matches the k-th on the other, and
only words without a partner are changed.  Stop words break
n-grams.  Terms are found in one pass over each stream, by an automaton of
the dictionary (``automaton``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelens.functions import text as tx
from changelens.operators import automaton
from changelens.operators import diffs as dif
from changelens.operators.joins import small

# Fixed value: the reference also treats '&' as a stop word.
EXTRA_STOP_WORDS = ["&"]


def default_stop_words(spark: SparkSession) -> DataFrame:
    """English stop words of Spark ML's StopWordsRemover plus '&',
    normalised like the text (quotes removed)."""
    from pyspark.ml.feature import StopWordsRemover

    from changelens.sources.local import values_table

    words = StopWordsRemover.loadDefaultStopWords("english") + EXTRA_STOP_WORDS
    df = values_table(spark, words, ["word"])
    return df.select(F.regexp_replace(F.lower("word"), tx.INFIX_QUOTES, "").alias("word")).distinct()


def term_dictionary(terms: DataFrame, col: str = "term") -> DataFrame:
    """TRM-07: normalise each term like the text, trim, dedupe; adds n_words."""
    t = F.trim(F.regexp_replace(tx.normalize_text(F.col(col)), " +", " "))
    return (terms.select(t.alias("term")).where(F.col("term") != "").distinct()
            .withColumn("n_words", F.size(F.split("term", " "))))


def words(labelled: DataFrame) -> DataFrame:
    """TRM-01: (pair_id, side, pos, wpos, word, changed).

    Words of unchanged units are unchanged and take no part in the second
    comparison, so its windows hold the changed units' words only."""
    w = labelled.select(
        "pair_id", "side", "pos", F.col("op") != 0,
        F.posexplode(F.split("unit", " ")),
    ).toDF("pair_id", "side", "pos", "changed", "wpos", "word")
    again = dif.label_units(
        w.where("changed").select("pair_id", "side", F.struct("pos", "wpos").alias("pos"), F.col("word").alias("unit")))
    return w.where("NOT changed").unionByName(again.select(
        "pair_id", "side", "pos.pos", "pos.wpos", F.col("unit").alias("word"), (F.col("op") != 0).alias("changed")))


def with_lines(labelled: DataFrame) -> DataFrame:
    """Add the place of a unit in its word stream, ``line``, and ``repeated``:
    places occur twice in the stream, so that units are no lines of one text."""
    side = Window.partitionBy("pair_id", "side")
    w = side.orderBy("pos")
    again = F.lag("pos").over(w) == F.col("pos")
    return (labelled.withColumn("line", F.row_number().over(w)).withColumn("_again", F.coalesce(again, F.lit(False)))
            .withColumn("repeated", F.max("_again").over(side)).drop("_again"))


def changed_ngrams(labelled: DataFrame, dictionary: DataFrame, stop_words: DataFrame,
                   max_n: int | None = None) -> DataFrame:
    """TRM-02..04: changed n-grams that are dictionary terms, of ``max_n``
    words at most, (pair_id, side, pos, wpos, n, term).

    A dictionary within the bounds of ``automaton`` is broadcast as one; a
    larger one is joined."""
    if max_n is not None:
        dictionary = dictionary.where(F.col("n_words") <= max_n)
    lists = automaton.collected(dictionary, stop_words)
    if lists is not None:
        return automaton.term_hits(labelled if "line" in labelled.columns else with_lines(labelled), *lists)
    return ngrams_by_join(labelled, dictionary, stop_words, max_n)


def ngrams_by_join(labelled: DataFrame, dictionary: DataFrame, stop_words: DataFrame,
                   max_n: int | None = None) -> DataFrame:
    """``changed_ngrams`` for dictionaries of any size: n-grams at words that
    start a term, joined with the terms."""
    if max_n is None:
        max_n = dictionary.agg(F.max("n_words")).first()[0] or 1
    w = words(labelled)
    stops = small(stop_words.select(F.col("word").alias("_sw")).distinct(), 200_000)
    w = w.join(stops, w.word == stops._sw, "left").withColumn("_stop", F.col("_sw").isNotNull()).drop("_sw")
    order = Window.partitionBy("pair_id", "side").orderBy("pos", "wpos")
    w = w.withColumn("_seg", F.sum(F.col("_stop").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    w = w.where(~F.col("_stop"))
    for k in range(1, max_n):
        w = (w.withColumn(f"_w{k}", F.lead("word", k).over(order))
              .withColumn(f"_c{k}", F.lead("changed", k).over(order))
              .withColumn(f"_s{k}", F.lead("_seg", k).over(order)))
    firsts = small(dictionary.select(F.split("term", " ")[0].alias("_first")).distinct(), 200_000)
    w = w.join(firsts, w.word == firsts._first, "left_semi")
    grams = []
    for n in range(1, max_n + 1):
        parts = [F.col("word")] + [F.col(f"_w{k}") for k in range(1, n)]
        same = F.lit(True)
        chg = F.col("changed")
        for k in range(1, n):
            same = same & (F.col(f"_s{k}") == F.col("_seg"))
            chg = chg | F.col(f"_c{k}")
        grams.append(F.struct(F.lit(n).alias("n"), F.concat_ws(" ", *parts).alias("term"),
                              (F.coalesce(same, F.lit(False)) & F.coalesce(chg, F.lit(False))).alias("ok")))
    g = w.select("pair_id", "side", "pos", "wpos", F.inline(F.array(*grams))).where("ok").drop("ok")
    d = small(dictionary.select("term", "n_words"), 200_000)
    return g.join(d, (g.term == d.term) & (g.n == d.n_words), "left_semi")


def key_term_net(ngrams: DataFrame) -> DataFrame:
    """TRM-05: net change per (pair, term) = added - removed, zeros dropped."""
    return (ngrams.groupBy("pair_id", "term")
            .agg(F.sum(F.when(F.col("side") == "b", 1).otherwise(-1)).cast("bigint").alias("net"))
            .where(F.col("net") != 0))


def key_term_summary(net: DataFrame) -> DataFrame:
    """TRM-06 per pair: key_terms map, key_terms_changed, key_terms_change_count."""
    return net.groupBy("pair_id").agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "net")))).alias("key_terms"),
        (F.count("*") > 0).alias("key_terms_changed"),
        F.sum(F.abs("net")).cast("bigint").alias("key_terms_change_count"),
    )
