"""The pipeline over small tables, stage by stage."""

import random

import corpus_pipeline
from brute import AWKWARD, SCHEMA, awkward, components
from test_search import PERSONAL

from climagrid.llm import line_dedup, quality

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        seen[name] = docs
        docs = stage(spark, docs, SF)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    verdicts = quality.quality_verdicts(seen["quality rules"])
    good = {r.doc_id for r in verdicts.where("kept").collect()}
    assert {r.doc_id for r in seen["line dedup"].collect()} == good
    lines = {r.doc_id: r.text for r in line_dedup.dedup_lines(seen["line dedup"]).collect()}
    before = seen["near duplicates"].collect()
    assert {r.doc_id: r.text for r in before} == lines
    assert all(r.n_chars == len(r.text) for r in before)
    groups = components([(r.doc_id, r.text) for r in before])
    kept = {r.doc_id for r in seen["personal data"].collect()}
    assert kept == {i for i, c in groups.items() if i == c}
    packed = docs.collect()
    assert {r.doc_id for r in packed} == kept
    assert {r.doc_id for r in corpus_pipeline.run(spark, SF).collect()} == kept


def test_rows_are_judged_one_by_one(spark):
    """Repeated and null ids: one row of each group of copies stays, and junk goes, whatever its id."""
    draw = random.Random(5)
    prose = [" ".join("".join(draw.choice("etaoinshr") for _ in range(4)) for _ in range(60)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(prose[:30])]
    rows += [(5, "junk"), (None, "junk"), (7, prose[7]), (7, prose[30]), (None, prose[31]), (None, prose[31])]
    rows += [(None, prose[8]), (3, prose[9]), (100, prose[32] + "\n" + prose[33]), (100, prose[33] + "\n" + prose[34])]
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], f"{SCHEMA}, n_chars bigint")
    stages = dict(corpus_pipeline.STAGES)
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text)
    good = sorted(stages["quality rules"](spark, docs, SF).collect(), key=key)
    assert not [r for r in good if r.text == "junk"] and {r.doc_id for r in good} >= {None, 5, 7, 100}
    once = sorted(stages["near duplicates"](spark, docs, SF).collect(), key=key)
    kept = [(r.doc_id, r.text) for r in once]
    smallest = {}
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        smallest.setdefault(t, i)
    assert sorted(kept, key=str) == sorted(((i, t) for t, i in smallest.items()), key=str)
    lines = stages["line dedup"](spark, docs, SF)
    texts = sorted(((r.doc_id, r.text) for r in lines.collect()), key=str)
    seen, expected = set(), []
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, n))
    for n in order:
        own = rows[n][1].split("\n")
        expected.append((rows[n][0], "\n".join(x for x in own if len(x) < 10 or x not in seen)))
        seen |= set(own)
    assert texts == sorted(expected, key=str)
    assert lines.columns == docs.columns


def test_stages_take_awkward_rows(spark):
    for table in (awkward(spark, AWKWARD + PERSONAL), spark.createDataFrame([], SCHEMA)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            kept = stage(spark, table, SF)
            assert kept.columns == table.columns and kept.count() <= table.count()
        name, stage = corpus_pipeline.STAGES[-1]
        packed = stage(spark, table, SF)
        assert packed.where("start = 0").count() == table.count()
