"""Quality rules and the co-trained classifier."""

import math
import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest
from brute import AWKWARD, BLANKS, SCHEMA, awkward, repeated_words

from climagrid.llm import chisquare, cotraining, quality
from climagrid.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def _plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    repeated = sum(line in lines[:i] for i, line in enumerate(lines))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return len(words), sum(map(len, words)), symbols, repeated, repeated_words(text)


def test_statistics_equal_the_definitions():
    draw = random.Random(2)
    bits = ["a", "b", "c ", " ", "\n", "é", "#", "<|>", "\x1c", "\x0b", "word ", "\xa0", "This is a line\n"]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(120))) for _ in range(400)]
    texts += ["x y z " * 30, "a a a a a a a a a", "one two three four five six seven eight " * 2, "", "\n\n"]
    for text in texts:
        assert quality.text_statistics(text)[:5] == _plain(text)


def test_chi_square():
    assert math.isclose(chisquare.cdf(2.0, 2), 1 - math.exp(-1), rel_tol=1e-12)
    assert math.isclose(chisquare.quantile(0.5, 2), 2 * math.log(2), rel_tol=1e-9)
    assert math.isclose(chisquare.quantile(0.99, 8), 20.090235, rel_tol=1e-6)
    assert chisquare.cdf(1e5, 8) == 1.0 and chisquare.cdf(0, 3) == 0.0


def _bounded(near, factor):
    """Mean, whitening matrix and log-determinant, no direction below 1 in units of the floors."""
    floors = np.array(list(quality.FLOORS.values()))
    values, axes = np.linalg.eigh(np.cov(near.T, bias=True) * factor / np.outer(floors, floors))
    spread = (axes * np.maximum(values, 1)) @ axes.T * np.outer(floors, floors)
    white = np.linalg.inv(np.linalg.cholesky(spread))
    return near.mean(axis=0), white, np.linalg.slogdet(spread)[1]


def _squared(points, mean, white):
    return np.square((points - mean) @ white.T).sum(axis=1)


def _edge(d2, share):
    """The bin up to which there is this share of the rows, by the same bins."""
    return np.sort(np.floor(16 * np.log2(d2 + 1e-6)))[math.ceil(share * len(d2)) - 1]


def _consistent(share):
    return share / chisquare.cdf(chisquare.quantile(share, 7), 9)


def _verdict(points):
    """Both distances and the verdict of one group, in plain numpy."""
    floors, count = np.array(list(quality.FLOORS.values())), len(points)
    at = lambda values, p: np.sort(values, axis=0)[max(0, math.ceil(p * count) - 1)]
    middle = at(points, 0.5)
    ranges = (at(points, 0.75) - at(points, 0.25)) / 1.349
    deviations = at(np.abs(points - middle), 0.5) / 0.6745
    found = []
    for start, spread in enumerate((ranges, deviations)):
        mean, white = middle, np.diag(1 / np.maximum(spread, floors))
        for _ in range(quality.STEPS):
            d2 = _squared(points, mean, white)
            near = points[np.floor(16 * np.log2(d2 + 1e-6)) <= _edge(d2, quality.SUPPORT)]
            mean, white, size = _bounded(near, _consistent(quality.SUPPORT))
        found.append((size - (0 if start else quality.CLEARLY), start, mean, white))
    d2 = _squared(points, *min(found, key=lambda f: f[:2])[2:])
    scale = lambda d: max(2 ** ((_edge(d, 0.5) + 1) / 16) / chisquare.quantile(0.5, 7), 1)
    near = points[d2 <= chisquare.quantile(quality.REWEIGHTED, 7) * scale(d2)]
    again = _squared(points, *_bounded(near, _consistent(quality.REWEIGHTED))[:2])
    return d2, again / scale(again)


@pytest.mark.parametrize("min_group", [quality.MIN_GROUP, 10**9])
def test_verdicts_equal_a_plain_estimate(spark, min_group):
    """Both distances and ``kept``, per group and with all rows in one."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = quality.quality_verdicts(docs, min_group=min_group).toPandas().set_index("doc_id")
    passed = quality._vector(quality.statistics(docs)).where("NOT base_failed")
    groups = quality._groups(passed, min_group)
    rows = passed.join(groups, ["lang", "source"]).toPandas()
    limit, seen = chisquare.quantile(quality.CONFIDENCE, 7), 0
    for _, own in rows.groupby("grp"):
        d2, judged = _verdict(own[list(quality.FLOORS)].to_numpy())
        mine = found.loc[own.doc_id]
        assert np.allclose(mine.d2, d2, rtol=1e-6) and np.allclose(mine.judged_d2, judged, rtol=1e-6)
        sure = np.abs(judged - limit) > 1e-3
        assert (mine.kept.to_numpy()[sure] == (judged <= limit)[sure]).all()
        seen += len(own)
    assert seen == len(rows) == (~found.base_failed).sum() and not found.kept[found.base_failed].any()


def test_a_third_of_junk_copies_does_not_become_the_norm(spark):
    draw, floors = np.random.default_rng(1), np.array(list(quality.FLOORS.values()))
    clean, junk = draw.normal(size=(670, 7)) * 2 * floors, np.linspace(3, 4, 7) * 2 * floors
    narrow = np.array([10, 0, 0, 0, 0, 0, 0]) * 2 * floors + clean[:400]
    limit = chisquare.quantile(quality.CONFIDENCE, 7)
    for good, bad in ((clean, np.tile(junk, (330, 1))), (np.vstack([clean, clean[400:]]), narrow)):
        table = pd.DataFrame(np.vstack([good, bad]), columns=list(quality.FLOORS)).assign(grp="g")
        rows = spark.createDataFrame(table.assign(good=[True] * len(good) + [False] * len(bad)))
        found = quality._reweighted(rows, quality.minimum_covariance(rows))
        judged = quality.lookup_join(rows, found, ["grp"]).withColumn("d2", quality._distance()).toPandas()
        assert (judged.d2[judged.good] <= limit).mean() > 0.99
        assert judged.d2[~judged.good].min() > limit


def test_labelled_junk_goes_and_clean_documents_stay(spark):
    labels = pd.read_parquet(f"{SF}/labels.parquet")
    found = QUERIES["op3_quality_rules"](spark, SF).toPandas().merge(labels, on="doc_id")
    failed = (found.n_words < 20) | (100 * found.n_repeat_words > 30 * found.n_words)
    assert (failed == found.base_failed).all() and not found.kept[failed].any()
    assert found.kept[(found.quality == 1) & ~failed].all()
    assert not found.kept[(found.quality == 0)].any()


def test_verdicts_of_awkward_rows(spark):
    rows = quality.quality_verdicts(awkward(spark)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    found = sorted((tuple(r)[:6] for r in rows), key=key)
    assert found == sorted(((i, *_plain(t)) for i, t, _, _ in AWKWARD), key=key)
    assert all(r.kept is False and r.d2 is None for r in rows if r.base_failed)
    assert all(r.kept is not None and r.d2 is not None for r in rows if not r.base_failed)
    assert quality.quality_verdicts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_small_groups_share_an_estimate(spark):
    sizes = [("en", "a", 5), ("en", "b", 2), ("en", "c", 2), ("fr", "a", 1), ("de", "z", 1)]
    rows = [(lang, source) for lang, source, n in sizes for _ in range(n)]
    groups = quality._groups(spark.createDataFrame(rows, "lang string, source string"), 4).collect()
    by = {(r["lang"], r["source"]): r["grp"] for r in groups}
    assert by["en", "b"] == by["en", "c"] != by["en", "a"]
    assert by["fr", "a"] == by["de", "z"] and len(set(by.values())) == 3


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_the_classifier_is_right_on_labels_it_has_not_seen(spark, tables):
    docs, labels = tables
    unseen = labels.where("doc_id % 3 = 0").toPandas()
    scores = cotraining.quality_scores(docs, labels.where("doc_id % 3 <> 0")).toPandas()
    assert len(scores) == docs.count() and scores.score.between(0, 1).all()
    both = scores.merge(unseen, on="doc_id")
    assert ((both.score >= 0.5) == (both.quality == 1)).mean() > 0.9
    assert (both.kept == (both.score >= 0.5)).all()


def test_scores_of_awkward_rows(spark, tables):
    labels = spark.createDataFrame([(3, 1, 0), (5, 0, 0), (None, 1, 0), (9, None, 1)], "doc_id bigint, quality int, toxic int")
    rows = cotraining.quality_scores(awkward(spark), labels, rounds=1).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in AWKWARD)
    assert all(0 <= r.score <= 1 for r in rows)
    one_class = cotraining.quality_scores(awkward(spark), labels.where("quality = 1"))
    assert {r.score for r in one_class.collect()} == {1.0}
    unlabelled = cotraining.quality_scores(awkward(spark), labels.limit(0))
    assert {r.score for r in unlabelled.collect()} == {0.5}
    assert cotraining.quality_scores(spark.createDataFrame([], SCHEMA), labels).count() == 0


def test_all_confident_rows_of_any_number_are_taught(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(i, Vectors.dense([1.0 if i % 3 else -1.0]), Vectors.dense([float(i)])) for i in range(30_000)]
    pool = spark.createDataFrame(rows, ["doc_id", "text_view", "page_view"])
    train = spark.createDataFrame(
        [(Vectors.dense([float(2 * (i % 2) - 1)]), float(i % 2), 1.0) for i in range(200)], ["text_view", "label", "weight"]
    )
    lesson = cotraining._lesson(pool, cotraining._fit(train, "text_view"), "text_view", "page_view")
    assert lesson.count() == 30_000 and lesson.where("label = 1").count() == 20_000
    weights = cotraining._weighed(lesson, train).groupBy("label").sum("weight").collect()
    assert all(math.isclose(r["sum(weight)"], 100) for r in weights)


def test_words_of_texts_are_not_kept():
    quality.text_statistics("one two")  # what a first call imports stays
    tracemalloc.start()
    try:
        for i in range(20):
            quality.text_statistics(" ".join(f"word{i}x{j}" for j in range(5000)))
        assert tracemalloc.get_traced_memory()[0] < 1_000_000
    finally:
        tracemalloc.stop()
