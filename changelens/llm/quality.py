"""Quality rules with risk-controlled cutoffs.

A rule rejects a document whose measure (share of symbols, shouting, repeated
words, ...) is above a cutoff.  Cutoffs are picked from a fixed grid, for each
stratum (language) and rule, on the labelled holdout: among its good documents
(quality 1) a cutoff wrongly rejects k of n.  It may be used only if the exact
binomial test rejects "the false rejection rate is above ``alpha``", that is
P(Bin(n, alpha) <= k) <= delta / m, where m counts every (stratum, rule,
cutoff) tried on a stratum with good labels (Bonferroni).  So with probability 1 - delta, no rule in use
rejects more than ``alpha`` of the good documents of any stratum.  Of the
certified cutoffs the one with the best balance of bad documents caught and
good ones lost is used, the larger one on ties; a rule that catches nothing,
or a stratum with too few labels for any certificate, stays unused.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelens.llm.common import SPACE_RE, join_on, table, words
from changelens.session import stage_table

ALPHA = 0.02
DELTA = 0.05
#: Bad documents that must be caught for each good one that is lost.
LOSS = 5
WINDOW = 8

#: Fixed grid of cutoffs of each rule.
GRID = {
    "symbols_per_word": (0.05, 0.1, 0.2, 0.3, 0.5, 1.0, 2.0),
    "bangs_per_word": (0.05, 0.1, 0.25, 0.5, 1.0, 1.5),
    "capital_share": (0.1, 0.2, 0.3, 0.5, 0.7, 0.9),
    "dup_line_share": (0.05, 0.1, 0.2, 0.3, 0.5),
    "repeat_share": (0.05, 0.1, 0.15, 0.2, 0.25, 0.3),
    "word_length": (8.0, 10.0, 12.0, 15.0, 20.0),
}


def _length_of(text: Column, other: str) -> Column:
    """How many characters of ``text`` are left when those of the class ``other`` go."""
    return F.length(F.regexp_replace(text, other, "")).cast("long")


def measures(docs: DataFrame, carry: bool = False) -> DataFrame:
    """doc_id, lang, n_words, word_chars, n_symbols, n_bangs, n_capitals,
    n_lines, n_dup_lines, n_repeat_words, and with ``carry`` the whole row as ``row``.

    Windows of ``WINDOW`` words that occur twice are found inside the row: hash
    the windows, and only where two hashes agree sort (hash, position) and
    count the words that repeated windows cover.  Within one text windows are
    told apart by their 64-bit hash.  A row holds some tens of bytes a word.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    row = [F.struct("*").alias("row")] if carry else []
    d = docs.select(*row, "doc_id", "lang", text.alias("text"), words(F.col("text")).alias("w"), lines.alias("lines"))
    d = d.select(
        *["row"] * carry, "doc_id", "lang", F.size("w").cast("long").alias("n_words"),
        _length_of(F.col("text"), SPACE_RE).alias("word_chars"), _length_of(F.col("text"), r"[^#*$%&|<>]+").alias("n_symbols"),
        _length_of(F.col("text"), r"[^!]+").alias("n_bangs"), _length_of(F.col("text"), r"[^A-Z]+").alias("n_capitals"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("w"))
    starts = F.sequence(F.lit(1), F.size("w") - (WINDOW - 1))
    hashes = F.when(F.size("w") > WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("w", i, WINDOW))))
    d = d.withColumn("hashes", hashes).drop("w")
    return d.withColumn("n_repeat_words", F.when(
        F.size(F.array_distinct("hashes")) < F.size("hashes"), _covered()).otherwise(0).cast("long")).drop("hashes")


def _covered() -> Column:
    """Words inside windows whose hash (in ``hashes``) occurs twice or more."""
    return F.expr(f"""
      element_at(transform(array(array_sort(transform(hashes, (h, i) -> struct(h, i)))), s ->
        aggregate(
          array_sort(transform(filter(s, (x, k) -> x.h = get(s, k - 1).h or x.h = get(s, k + 1).h), x -> x.i)),
          struct(-{WINDOW} as last, 0 as n),
          (a, i) -> struct(i as last, a.n + least({WINDOW}, i - a.last) as n),
          a -> a.n)), 1)""")


def with_rates(m: DataFrame) -> DataFrame:
    """Add the rules' measures as rates; 0 where there is nothing to divide by."""
    rate = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return m.withColumns({
        "symbols_per_word": rate("n_symbols", "n_words"), "bangs_per_word": rate("n_bangs", "n_words"),
        "capital_share": rate("n_capitals", "word_chars"), "dup_line_share": rate("n_dup_lines", "n_lines"),
        "repeat_share": rate("n_repeat_words", "n_words"), "word_length": rate("word_chars", "n_words"),
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))})


def binomial_tail(k: str, n: str, rate: float) -> Column:
    """P(Bin(n, rate) <= k) for rate in (0, 1), summed term by term; 1 where k is at least the mean.

    Below the mean terms only fall from k downwards, so those that underflow don't count.
    """
    odds = rate / (1 - rate)
    return F.expr(f"""
      CASE WHEN {k} >= {n} * {rate!r}D THEN 1.0D
           WHEN {k} = 0 THEN exp({n} * ln(1 - {rate!r}D))
           ELSE aggregate(sequence(1L, {k}),
             named_struct('t', {n} * ln(1 - {rate!r}D), 's', exp({n} * ln(1 - {rate!r}D))),
             (a, j) -> named_struct(
               't', a.t + ln(({n} - j + 1) / cast(j AS double) * {odds!r}D),
               's', a.s + exp(a.t + ln(({n} - j + 1) / cast(j AS double) * {odds!r}D))),
             a -> a.s) END""")


def cutoffs(rated: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA) -> DataFrame:
    """(stratum, rule, cutoff, k, n, caught, p_value): the cutoffs in use, one row per stratum and rule.

    ``labels``: doc_id, quality (1 good, 0 bad; a document with several labels
    counts once for each distinct one, others are left out).  Documents that
    the base rules reject anyway are no part of the holdout.  Partial sums, so
    a stratum of any size is one row from each task.
    """
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id"), "quality").distinct()
    held = rated.where(~F.col("base_failed")).join(known, "doc_id")
    hit = lambda rule, c, good: F.sum(((F.col(rule) > c) & (F.col("quality") == good)).cast("long"))
    counts = held.groupBy(F.col("lang").alias("stratum")).agg(
        F.sum((F.col("quality") == 1).cast("long")).alias("n"),
        F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(c).alias("cutoff"), hit(rule, c, 1).alias("k"), hit(rule, c, 0).alias("caught"))
                  for rule, cs in GRID.items() for c in cs]).alias("tried"))
    tried = counts.select("stratum", "n", F.explode("tried").alias("t")).select("stratum", "n", "t.*")
    m = F.count("*").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    tested = tried.where("n > 0").withColumn("m", m).withColumn("p_value", binomial_tail("k", "n", alpha))
    used = tested.where((F.col("p_value") <= delta / F.col("m")) & (F.col("caught") > LOSS * F.col("k")))
    best = Window.partitionBy("stratum", "rule").orderBy((F.col("caught") - LOSS * F.col("k")).desc(), F.col("cutoff").desc())
    return used.withColumn("r", F.row_number().over(best)).where("r = 1").select(
        "stratum", "rule", "cutoff", "k", "n", "caught", "p_value")


def judge(docs: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, carry: bool = False) -> DataFrame:
    """One row per document: the measures, base_failed, kept, and with ``carry`` the whole row as ``row``.

    Defined cases: a null text has no words, so it fails the base rules; a null
    language is a stratum of its own; without labels (or for a stratum without
    any certified cutoff) the base rules decide alone.  Rows that repeat are
    judged alike.  An empty table gives an empty result.
    """
    rated = with_rates(stage_table(measures(docs, carry), "quality-measures"))
    chosen = stage_table(cutoffs(rated, labels, alpha, delta), "quality-cutoffs")
    # one row per stratum: a column for each rule
    limits = chosen.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == rule, F.col("cutoff"))).alias(f"max_{rule}") for rule in GRID])
    verdict = ~F.col("base_failed")
    for rule in GRID:
        verdict = verdict & ~F.coalesce(F.col(rule) > F.col(f"max_{rule}"), F.lit(False))
    return join_on(rated, limits, {"lang": "stratum"}, "left").withColumn("kept", verdict).drop(
        *[f"max_{rule}" for rule in GRID])


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns.

    Whole rows are staged with their measures, so neither texts are shuffled
    nor the measures taken twice, and a verdict is always on its own row.
    """
    return judge(docs, labels, carry=True).where("kept").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_TRIED = ", ".join(f"('{rule}', {c})" for rule, cs in GRID.items() for c in cs)
SQL = f"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, row_number() OVER () AS row_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
        [x FOR x IN string_split(text, chr(10)) IF regexp_matches(x, '[^\\x20\\x09-\\x0D]')] AS lines FROM d),
win AS (SELECT row_id, i, list_slice(words, i, i + {WINDOW - 1}) AS x
        FROM (SELECT row_id, words, unnest(range(1, len(words) - {WINDOW - 2})) AS i FROM w WHERE len(words) >= {WINDOW})),
rep AS (SELECT row_id, unnest(range(i, i + {WINDOW})) AS place
        FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, x) AS n FROM win) WHERE n > 1),
cov AS (SELECT row_id, count(DISTINCT place) AS n FROM rep GROUP BY row_id),
m AS (SELECT w.row_id, doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
        length(regexp_replace(text, '[^!]', '', 'g')) AS n_bangs, length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_capitals,
        len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
      FROM w LEFT JOIN cov USING (row_id)),
r AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
        coalesce(n_symbols / nullif(n_words, 0), 0) AS symbols_per_word, coalesce(n_bangs / nullif(n_words, 0), 0) AS bangs_per_word,
        coalesce(n_capitals / nullif(word_chars, 0), 0) AS capital_share, coalesce(n_dup_lines / nullif(n_lines, 0), 0) AS dup_line_share,
        coalesce(n_repeat_words / nullif(n_words, 0), 0) AS repeat_share, coalesce(word_chars / nullif(n_words, 0), 0) AS word_length
      FROM m),
v AS (SELECT doc_id, row_id, lang, base_failed, unnest([{", ".join(f"{{'rule': '{rule}', 'v': CAST({rule} AS DOUBLE)}}" for rule in GRID)}], recursive := true) FROM r),
held AS (SELECT v.*, q.quality FROM v JOIN (SELECT DISTINCT doc_id, quality FROM labels WHERE quality IN (0, 1)) q USING (doc_id) WHERE NOT base_failed),
t AS (SELECT lang, h.rule, g.cutoff, count(*) FILTER (quality = 1) AS n, count(*) FILTER (quality = 1 AND v > g.cutoff) AS k,
        count(*) FILTER (quality = 0 AND v > g.cutoff) AS caught
      FROM held h JOIN (VALUES {_TRIED}) g(rule, cutoff) ON h.rule = g.rule GROUP BY ALL),
p AS (SELECT *, count(*) OVER () AS m, (SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({ALPHA}) + (n - j) * ln(1 - {ALPHA})))
        FROM (SELECT unnest(range(0, k + 1)) AS j)) AS p_value FROM t WHERE n > 0),
used AS (SELECT * FROM p WHERE p_value <= {DELTA} / m AND caught > {LOSS} * k),
best AS (SELECT lang, rule, cutoff FROM used
         QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY caught - {LOSS} * k DESC, cutoff DESC) = 1),
bad AS (SELECT DISTINCT v.row_id FROM v JOIN best b ON v.lang IS NOT DISTINCT FROM b.lang AND v.rule = b.rule AND v.v > b.cutoff)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND row_id NOT IN (SELECT row_id FROM bad) AS kept
FROM r
"""
