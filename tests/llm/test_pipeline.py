"""The pipeline's stages against plain versions, each on its own input, and the whole run."""

from collections import Counter

import corpus_pipeline
import pytest
from conftest import SF

from changelens.llm import mixing, quality
from changelens.llm.common import table
from changelens.session import drop_stages

from .conftest import frame
from .test_native_ops import plain_dedup, plain_measures
from .test_python_ops import plain_components, plain_fingerprint


def stages():
    return dict(corpus_pipeline.STAGES)


def rows_of(docs):
    return [(r.doc_id, r.text, r.lang, r.source) for r in docs.collect()]


def test_stage_order():
    assert list(stages()) == ["quality rules", "exact dedup", "near dedup", "mixing", "bpe"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_in_turn(spark, tmp_path):
    docs = table(spark, SF, "documents")
    steps = stages()
    kept = {r.doc_id for r in quality.judge(docs, table(spark, SF, "labels")).collect() if r.kept}
    want = [r for r in rows_of(docs) if r[0] in kept]
    assert kept == {r[0] for r in rows_of(docs) if not plain_measures(r[1])[5]}  # too few labels here for a cutoff

    def step(name, docs):
        out = steps[name](spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    one = step("quality rules", docs)
    assert one.columns == docs.columns
    assert Counter(rows_of(one)) == Counter(want)
    two = step("exact dedup", one)
    want = [r for r in want if r[0] in {x[0] for x in plain_dedup(want) if x[3]}]
    assert Counter(rows_of(two)) == Counter(want)
    three = step("near dedup", two)
    firsts = {i for i, _, low in plain_components([(r[0], plain_fingerprint(r[1])) for r in want]) if i == low}
    want = [r for r in want if r[0] in firsts]
    assert Counter(rows_of(three)) == Counter(want)
    four = step("mixing", three)
    assert four.columns == docs.columns
    copies = {r.doc_id: r.copies for r in mixing.mix(three).collect()}
    want = [r for r in want for _ in range(copies[r[0]])]
    assert Counter(rows_of(four)) == Counter(want)
    five = step("bpe", four)
    assert Counter(r.doc_id for r in five.collect()) == Counter(r[0] for r in want)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, five.collect()))
    assert drop_stages(spark) > 0


@pytest.mark.parametrize("name", ["quality rules", "exact dedup", "near dedup", "mixing", "bpe"])
def test_stages_take_odd_and_empty_tables(spark, odd, empty, name):
    for docs in (odd, empty):
        out = stages()[name](spark, docs, SF)
        assert name == "bpe" or out.columns == docs.columns
        assert out.count() <= 3 * docs.count()


def test_one_document_of_each_group_stays(spark):
    """Repeated rows, groups of null ids alone and an id with two texts."""
    long = [f"word{i}" for i in range(400)]
    near = " ".join([*long[:-1], "other"])
    assert (plain_fingerprint(" ".join(long)) ^ plain_fingerprint(near)).bit_count() <= 2
    rows = [(5, "twice", "en", "a")] * 3 + [(None, "No id", "en", "a"), (None, "no id", "en", "b"), (None, "NO ID", "en", "c")]
    rows += [(6, "mixed ids", "en", "a"), (None, "Mixed ids", "en", "a")]
    left = rows_of(stages()["exact dedup"](spark, frame(spark, rows), SF))
    assert Counter(r[1].lower() for r in left) == Counter(["twice", "no id", "mixed ids"])
    assert {r[0] for r in left if r[1].lower() == "mixed ids"} == {6}
    for ids in ((None, None, None), (8, 8, 8), (None, 9, 9)):
        rows = list(zip(ids, (" ".join(long), near, near), ("en",) * 3, ("a",) * 3, strict=True))
        left = rows_of(stages()["near dedup"](spark, frame(spark, rows), SF))
        assert len(left) == 1
        assert left[0][0] == ids[-1]
