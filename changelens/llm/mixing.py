"""Mixing sources to target weights by pivotal dependent rounding.

A source whose target is m times its size wants every document m times.  Each
document takes floor(m) copies; the fraction p left over is a probability of
one more copy.  Pivotal rounding settles these: of two fractional documents,
words are moved at random from one to the other until one of them is at 0 or
1, and the other goes on.  A move keeps size_i * p_i + size_j * p_j and each
p's expectation, so a source's words stay at its target but for the rounding
of the one document that is left over.

The documents of a source are numbered by falling size; blocks of ``BLOCK``
neighbours are settled in parallel, each passes on its one undecided document,
and those are again put in blocks: a reduction tree of log_BLOCK(rows) levels
in which no group is larger than a block.  All random numbers are hashes, and
the numbering is a total order, so reruns agree.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from changelens.llm.common import count_words, free_name, join_on, table, unit, with_rank, with_row_number
from changelens.session import stage_table

BLOCK = 64
MAX_COPIES = 3
SEED = 20240817


def source_targets(sizes: DataFrame, max_copies: int = MAX_COPIES) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    Weights are 1, 2, 3, 1, ... in order of source, null last.  With the
    sources in order of cap / weight, those in front are at their cap and the
    rest share what is left by weight; the first source that need not be
    capped gives the level.  One row per source, a few numbers each.
    """
    w = Window.orderBy(F.col("source").asc_nulls_last())
    s = (
        sizes.withColumn("weight", (F.row_number().over(w) - 1) % 3 + 1)
        .withColumn("cap", F.col("source_size") * max_copies)
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    front = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    s = s.withColumn(
        "level",
        (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(front), F.lit(0)))
        / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(front), F.lit(0))),
    ).withColumn("place", F.row_number().over(by_ratio))
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("place", "level"))).over(whole)
    return s.withColumn("share", F.coalesce(first["level"], F.lit(0.0))).select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.col("weight") * F.col("share")).alias("target"))


def _pivot(state: Column, x: Column) -> Column:
    """One pivotal step: ``state.open`` against ``x``; the one that becomes
    integral joins ``state.done``."""
    i, j = state["open"], x
    up = F.least((1 - i["p"]) * i["size"], j["p"] * j["size"])    # words that i can take from j
    down = F.least(i["p"] * i["size"], (1 - j["p"]) * j["size"])  # words that j can take from i
    i_takes = j["u"] * (up + down) < down
    i_full = (1 - i["p"]) * i["size"] <= j["p"] * j["size"]
    i_bare = i["p"] * i["size"] <= (1 - j["p"]) * j["size"]
    i_ends = (i_takes & i_full) | (~i_takes & i_bare)
    moved = F.when(i_takes, up).otherwise(-down)

    def at(doc: Column, words: Column) -> Column:
        p = F.greatest(F.lit(0.0), F.least(F.lit(1.0), doc["p"] + words / doc["size"]))
        return F.struct(doc["id"].alias("id"), doc["size"].alias("size"), p.alias("p"), doc["u"].alias("u"))

    ended = F.struct(F.when(i_ends, i["id"]).otherwise(j["id"]).alias("id"), (i_takes == i_ends).alias("up"))
    return F.struct(
        F.when(i_ends, at(j, -moved)).otherwise(at(i, moved)).alias("open"),
        F.concat(state["done"], F.array(ended)).alias("done"))


def pivotal(rows: DataFrame, seed: int = SEED, block: int = BLOCK) -> DataFrame:
    """(source, id, up) for rows (source, id, size, p): id numbers a source's rows from 0."""
    top = rows.agg(F.max("id")).first()[0]
    levels = 0 if top is None else 1
    while top is not None and block**levels <= top:
        levels += 1
    settled = []
    todo = rows.withColumn("place", F.col("id"))
    for level in range(1, levels + 1):
        item = F.struct(
            "place", F.struct("id", "size", "p", unit(F.lit(seed), F.lit(level), F.col("source"), F.col("id")).alias("u")).alias("x"))
        sized = todo.groupBy("source", F.floor(F.col("place") / block).cast("long").alias("block")).agg(
            F.array_sort(F.collect_list(item)).alias("rows")).withColumn("rows", F.transform("rows", lambda r: r["x"]))
        start = F.struct(
            F.element_at("rows", 1).alias("open"), F.array().cast("array<struct<id:bigint,up:boolean>>").alias("done"))
        done = stage_table(
            sized.withColumn("end", F.aggregate(F.expr("slice(rows, 2, size(rows))"), start, _pivot))
            .select("source", "block", "end.open", "end.done"), "pivot")
        settled.append(done.select("source", F.explode("done").alias("d")).select("source", "d.id", "d.up"))
        todo = done.select("source", F.col("block").alias("place"), "open.id", "open.size", "open.p")
    last = todo.select("source", "id", (F.col("p") >= 0.5).alias("up"))
    return reduce(DataFrame.unionByName, settled, last)


def mix(docs: DataFrame, seed: int = SEED, number: str | None = None) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken,
    and with ``number`` that column of ``docs``, which then also settles ties.

    Defined cases: a null text has size 0; documents of size 0 take no copies;
    a null source is a source of its own, the last; sources without words have
    target 0.  Rows that repeat are documents of their own.  Where nothing has
    words every target is 0; an empty table gives an empty result.
    """
    own = [number] if number else []
    sized = stage_table(docs.select(*own, "doc_id", "source", count_words(F.col("text")).alias("size")), "mix-sizes")
    targets = stage_table(
        source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))), "mix-targets")
    times = F.when(F.col("source_size") > 0, F.least(F.lit(float(MAX_COPIES)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    goal = targets.withColumn("base", F.floor(times).cast("long")).withColumn("p", times - F.col("base"))
    ranked = with_rank(
        sized, ["source"], [F.col("size").desc(), F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id"), *map(F.col, own)])
    ranked = join_on(ranked, goal, ["source"])
    picks = pivotal(
        ranked.where((F.col("size") > 0) & (F.col("p") > 0))
        .select("source", F.col("rank").alias("id"), "size", "p"), seed)
    copies = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        F.col("base") + F.coalesce(F.col("up").cast("long"), F.lit(0))).cast("long")
    return (
        join_on(ranked, picks, {"source": "source", "rank": "id"}, "left")
        .select(*own, "doc_id", "source", "size", "source_size", "target", copies.alias("copies"))
        .withColumn("taken", F.col("copies") * F.col("size"))
    )


def mixed_documents(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (not at all for 0).

    Rows are known by a number of their own, so ids that are null or repeat
    never share copies.
    """
    n, copy = (free_name(c, docs) for c in ("_copies", "_copy"))
    rows, number = with_row_number(docs, "mix-rows")
    copies = mix(rows, seed, number).where("copies > 0").select(number, F.col("copies").cast("int").alias(n))
    return join_on(rows, copies, [number], hint="merge").withColumn(
        copy, F.explode(F.array_repeat(F.lit(1), F.col(n)))).select(*docs.columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents")).drop("source")
