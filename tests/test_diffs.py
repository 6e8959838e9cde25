"""Bag diffs and terms: invariants (DIF-03..10, TRM-*)."""

from pyspark.sql import functions as F

from changelens.operators import diffs as dif
from changelens.operators import terms as trm
from changelens.sources.local import values_table


def units(spark, a, b):
    rows = [(1, "a", i, u) for i, u in enumerate(a)] + [(1, "b", i, u) for i, u in enumerate(b)]
    return spark.createDataFrame(rows, "pair_id long, side string, pos int, unit string")


def test_equal_sides_empty_hash(spark):
    m = dif.text_metrics(dif.label_units(units(spark, ["x", "y"], ["x", "y"]))).first()
    assert m.diff_hash == dif.EMPTY_HASH and m.diff_count == 0 and m.percent_changed == 0.0


def test_moves_are_not_changes_and_runs_merge(spark):
    lab = dif.label_units(units(spark, ["a", "b", "c", "d"], ["c", "a", "x", "y", "b"]))
    ops = {(r.side, r.unit): r.op for r in lab.collect()}
    assert ops[("a", "d")] == -1 and ops[("b", "x")] == 1 and ops[("a", "a")] == 0
    m = dif.text_metrics(lab).first()
    assert m.diff_count == 2            # 'x y' is one run, 'd' another
    assert m.diff_max_length == 3       # 'x\ny'


def test_swap_flips_ops(spark):
    a, b = ["p", "q", "r"], ["q", "s"]
    one = {(r.unit, r.op) for r in dif.label_units(units(spark, a, b)).where("op != 0").collect()}
    two = {(r.unit, -r.op) for r in dif.label_units(units(spark, b, a)).where("op != 0").collect()}
    assert one == two


def test_ordered_diff_puts_removed_lines_in_place(spark):
    lab = dif.label_units(units(spark, ["a", "gone1", "b", "gone2", "c"], ["a", "b", "new", "c"]))
    rows = dif.ordered_diff(lab).orderBy("seq").collect()
    assert [(r.op, r.unit) for r in rows] == [(0, "a"), (-1, "gone1"), (0, "b"), (-1, "gone2"), (1, "new"), (0, "c")]


def test_key_term_net(spark):
    lab = dif.label_units(units(spark, ["the old green energy plan"], ["the new green energy plan", "green energy"]))
    d = trm.term_dictionary(values_table(spark, ["Green Energy", "plan"], ["term"]))
    sw = values_table(spark, ["the"], ["word"])
    net = {r.term: r.net for r in trm.key_term_net(trm.changed_ngrams(lab, d, sw)).collect()}
    # removed line: one "green energy", one "plan"; added lines: two and one
    assert net == {"green energy": 1}


def test_normalize_text(spark):
    from changelens.functions import text as tx
    df = spark.createDataFrame([("Ça va? L'été—très  Straße_x",)], "t string")
    assert df.select(tx.normalize_text(F.col("t")).alias("n")).first().n == "ca va lete tres strasse_x"


def test_marks_and_other_scripts(spark):
    from changelens.functions import text as tx
    df = spark.createDataFrame([("e\u0301te\u0301 Ž Ωμέγα Йод 한글",)], "t string")
    assert df.select(tx.normalize_text(F.col("t")).alias("n")).first().n == "ete z ωμεγα иод 한글"
    assert df.select(tx.normalize_text_exact(F.col("t")).alias("n")).first().n.startswith("ete z ωμεγα иод")


# ---------------------------------------------------------------- ordered scripts (DIF-06)
import random  # noqa: E402
import time  # noqa: E402

from changelens.operators import scripts as osc  # noqa: E402


def lcs_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diag = 0
        for j, y in enumerate(b, 1):
            here = row[j]
            row[j] = diag + 1 if x == y else max(here, row[j - 1])
            diag = here
    return row[-1]


def script_of(spark, a, b):
    return [(r.op, r.unit) for r in osc.ordered_script(units(spark, a, b)).orderBy("seq").collect()]


def test_scripts_are_shortest():
    rng = random.Random(4)
    for k in range(1500):
        kinds = rng.choice([1, 2, 4, 20, 200])
        a = [rng.randrange(kinds) for _ in range(rng.randint(0, 30))]
        b = rng.sample(a, len(a)) if k % 3 == 0 else [rng.randrange(kinds) for _ in range(rng.randint(0, 30))]
        got = osc.kept_places(a, b)
        assert len(got) == lcs_length(a, b) and all(a[i] == b[j] for i, j in got)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(got, got[1:], strict=False))


def test_moved_units_are_removed_and_added(spark):
    assert script_of(spark, list("ABCDE"), list("EABCD")) == [(1, "E"), *[(0, x) for x in "ABCD"], (-1, "E")]
    assert script_of(spark, ["a", "gone", "b", "c"], ["c", "a", "b", "new"]) == [(1, "c"), (0, "a"), (-1, "gone"), (0, "b"), (-1, "c"), (1, "new")]


def test_scripts_rebuild_both_sides(spark):
    rng = random.Random(2)
    rows, docs = [], {}
    for pair in range(40):
        for side in "ab":
            doc = docs[pair, side] = [f"u{rng.randrange(6)}" for _ in range(rng.randint(0, 15))]
            rows += [(pair, side, 3 * i, u) for i, u in enumerate(doc)]
    df = spark.createDataFrame(rows, "pair_id long, side string, pos int, unit string")
    got = osc.ordered_script(df).orderBy("pair_id", "seq").collect()
    for (pair, side), doc in docs.items():
        mine = [(r.unit, r.pos) for r in got if r.pair_id == pair and r.op in (0, 1 if side == "b" else -1)]
        assert [u for u, _ in mine] == doc
        if side == "b":
            assert [p for _, p in mine] == [3 * i for i in range(len(doc))]
    runs = osc.script_runs(osc.ordered_script(df)).groupBy().sum("n_units").first()[0]
    assert runs == sum(r.op != 0 for r in got)
    assert osc.ordered_script(df.limit(0)).count() == 0


def test_long_scripts_take_no_time():
    rng = random.Random(1)
    for kinds in (50, 10**9):
        a = [rng.randrange(kinds) for _ in range(10_000)]
        start = time.process_time()
        osc.kept_places(a, rng.sample(a, len(a)))
        assert time.process_time() - start < 5


# ---------------------------------------------------------------- words of changed lines (TRM-01)
def test_one_new_word_changes_only_its_ngrams(spark):
    lab = dif.label_units(units(spark, ["clean air act and green energy", "same line"], ["clean air act and new green energy", "same line"]))
    d = trm.term_dictionary(values_table(spark, ["clean air", "air act", "green energy", "new green", "new green energy", "act and new", "same line"], ["term"]))
    got = {r.term for r in trm.changed_ngrams(lab, d, values_table(spark, ["the"], ["word"])).collect()}
    assert got == {"new green", "new green energy", "act and new"}


def test_words_moved_between_changed_lines_are_unchanged(spark):
    lab = dif.label_units(units(spark, ["a b c", "d"], ["a b", "c d d"]))
    changed = sorted((r.side, r.word) for r in trm.words(lab).where("changed").collect())
    assert changed == [("b", "d")]


# ---------------------------------------------------------------- many terms (TRM-04)
from changelens.operators import automaton  # noqa: E402


def test_automaton_finds_overlapping_terms():
    rng = random.Random(6)
    for _ in range(300):
        terms = list({" ".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(1, 12))})
        stream = [rng.choice("abcd") for _ in range(30)]
        m, at, got = automaton.Automaton(terms), 0, []
        for i, w in enumerate(stream):
            at = m.next(at, w)
            got += [(i - n + 1, n) for n in m.sizes(at)]
        assert sorted(got) == sorted((i, n) for n in range(1, 5) for i in range(31 - n) if " ".join(stream[i : i + n]) in terms)


def test_large_dictionary_gives_the_joined_rows(spark):
    """200,000 terms of up to six words: the rows of the join."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    line = lambda: " ".join(rng.choice(vocabulary[:60] + ["the"]) for _ in range(rng.randint(1, 12)))
    rows = [(p, s, i, line()) for p in range(6) for s in "ab" for i in range(12)]
    lab = dif.label_units(spark.createDataFrame(rows, "pair_id long, side string, pos int, unit string"))
    texts = [r[3].split() for r in rows]
    terms = {" ".join(t[i : i + n]) for t in texts for n in range(1, 7) for i in range(len(t) - n + 1) if rng.random() < 0.5}
    terms |= {" ".join(rng.choice(vocabulary) for _ in range(rng.randint(2, 6))) for _ in range(200_000)}
    d = trm.term_dictionary(spark.createDataFrame([(t,) for t in terms], "term string"))
    stop = values_table(spark, ["the"], ["word"])
    cols = ["pair_id", "side", "pos", "wpos", "n", "term"]
    got = sorted(map(tuple, trm.changed_ngrams(lab, d, stop).select(cols).collect()))
    assert got == sorted(map(tuple, trm.ngrams_by_join(lab, d, stop).select(cols).collect())) and len(got) > 300
    assert {r[4] for r in got} == {1, 2, 3, 4, 5, 6}


def test_dictionaries_beyond_the_bound_are_joined(spark, monkeypatch):
    lab = dif.label_units(units(spark, ["old plan"], ["green energy plan"]))
    d = trm.term_dictionary(values_table(spark, ["green energy", "plan", "old"], ["term"]))
    stop = values_table(spark, ["the"], ["word"])
    rows = lambda: sorted((r.side, r.term) for r in trm.changed_ngrams(lab, d, stop).collect())
    near = rows()
    monkeypatch.setattr(automaton, "MAX_TERMS", 2)
    assert automaton.collected(d, stop) is None and rows() == near == [("a", "old"), ("b", "green energy")]
