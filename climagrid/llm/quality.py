"""Text statistics and robust multivariate outliers per language and source."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from climagrid.llm import chisquare
from climagrid.llm.minhash import window_hashes, word_codes
from climagrid.llm.shipping import with_modules
from climagrid.llm.units import let_go, text_slices
from climagrid.operators.joins import lookup_join
from climagrid.sources.scratch import materialize

BLANKS = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30

#: Groups with fewer rows share an estimate: with their language's other small ones, or with all.
MIN_GROUP = 200
#: Share of a group's rows that an estimate rests on, and improvement steps. Just over a half stands
#: the most junk, a little less than the other half.
SUPPORT, STEPS = 0.51, 10
#: Another start's estimate is taken if the logarithm of its determinant is lower by more than this;
#: less is what a start still lacks after ``STEPS``.
CLEARLY = 0.1
#: Rows within this quantile under the best estimate take part in the reweighted one.
REWEIGHTED = 0.975
#: A row is rejected beyond this quantile of the chi-square distribution.
CONFIDENCE = 1 - 1e-4

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_MORE = ("n_lines", "n_upper", "n_echoes")

#: Components of the vector and the least deviation that each is credited with: measured in these, no
#: direction has a variance below 1. Most texts have no symbols or repeats at all, so without a bound the
#: estimated covariances would be singular; where a group's own spread is larger, that alone counts.
FLOORS = {
    "x_words": 0.5,
    "x_length": 0.08,
    "x_symbols": 0.6,
    "x_upper": 0.4,
    "x_echoes": 0.5,
    "x_repeats": 1.0,
    "x_lines": 0.8,
}
_DIMS = len(FLOORS)


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside any window of words that occurs at least twice in the text."""
    if len(words) <= window:
        return 0
    hashes = window_hashes(word_codes(words), window)
    values, where, counts = np.unique(hashes, return_inverse=True, return_counts=True)
    if len(values) == len(hashes):
        return 0
    # Equal windows have equal hashes; the words themselves decide about the others.
    suspects = np.flatnonzero(counts[where] > 1)
    seen: dict[tuple, list[int]] = {}
    for i in suspects.tolist():
        seen.setdefault(tuple(words[i : i + window]), []).append(i)
    edges = np.zeros(len(words) + 1, np.int64)
    for places in seen.values():
        if len(places) > 1:
            np.add.at(edges, places, 1)
            np.subtract.at(edges, np.asarray(places) + window, 1)
    return int((np.cumsum(edges)[:-1] > 0).sum())


def text_statistics(text: str) -> tuple[int, ...]:
    """The values of ``STATISTICS`` and, besides, lines, capitals A-Z, and words equal to the last."""
    data = text.encode()
    words = data.split()  # of bytes: the ASCII blanks only
    lines = [line for line in text.split("\n") if line.strip(BLANKS)]
    codes = np.frombuffer(data, np.uint8)
    return (
        len(words),
        len(text) - sum(map(text.count, BLANKS)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        int(((codes >= 65) & (codes <= 90)).sum()),
        sum(map(bytes.__eq__, words, words[1:])),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source``, the statistics of the text and ``base_failed``, row by row."""
    numbers = STATISTICS + _MORE
    kind = pa.schema(
        [("doc_id", pa.int64()), ("lang", pa.string()), ("source", pa.string())]
        + [(name, pa.int64()) for name in numbers]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for batch in batches:
            for part in text_slices(batch, "text"):
                found = [text_statistics(t) for t in part.column("text").to_pylist()]
                columns = np.array(found, np.int64).T
                arrays = [*part.columns[:3], *(pa.array(c) for c in columns)]
                yield pa.RecordBatch.from_arrays(arrays, schema=kind)

    chosen = docs.select(
        F.col("doc_id").cast("bigint"),
        *[_column(docs, name) for name in ("lang", "source")],
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    schema = "doc_id bigint, lang string, source string, " + ", ".join(f"{n} bigint" for n in numbers)
    few = F.col("n_words") < MIN_WORDS
    repeats = 100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    return with_modules(chosen).mapInArrow(run, schema).withColumn("base_failed", few | repeats)


def _column(docs: DataFrame, name: str) -> Column:
    """A label column as text; null, or missing altogether, counts as a label of its own."""
    found = F.col(name).cast("string") if name in docs.columns else F.lit(None)
    return F.coalesce(found, F.lit("\0")).alias(name)


def _vector(rows: DataFrame) -> DataFrame:
    """Adds the transformed statistics; for texts with words."""

    def share(count: str, total: str) -> Column:
        return F.log1p(100 * F.col(count) / F.greatest(F.col(total), F.lit(1)))

    return rows.withColumns(
        {
            "x_words": F.log1p("n_words"),
            "x_length": F.log(F.greatest("word_chars", F.lit(1)) / F.greatest("n_words", F.lit(1))),
            "x_symbols": share("n_symbols", "n_words"),
            "x_upper": share("n_upper", "word_chars"),
            "x_echoes": share("n_echoes", "n_words"),
            "x_repeats": share("n_repeat_words", "n_words"),
            "x_lines": F.log1p("n_dup_lines"),
        }
    )


def _groups(rows: DataFrame, min_group: int) -> DataFrame:
    """``lang, source, grp``: the group whose estimate judges the rows."""
    sizes = materialize(rows.groupBy("lang", "source").agg(F.count("*").alias("n")), "group-sizes")
    small = sizes.where(F.col("n") < min_group)
    pools = small.groupBy("lang").agg(F.sum("n").alias("pooled"))
    own = F.concat_ws("\1", "lang", "source")
    pool = F.when(F.col("pooled") >= min_group, F.concat_ws("\1", "lang", F.lit(""), F.lit("")))
    named = sizes.join(pools, "lang", "left")
    group = F.when(F.col("n") >= min_group, own).otherwise(F.coalesce(pool, F.lit("")))
    return materialize(named.select("lang", "source", group.alias("grp")), "groups")


_NAMES = list(FLOORS)
_PAIRS = [(i, j) for i in range(_DIMS) for j in range(i + 1)]
_ESTIMATE = ["grp", "start", *[f"m{i}" for i in range(_DIMS)], *[f"w{i}_{j}" for i, j in _PAIRS]]


def _distance() -> Column:
    """The squared Mahalanobis distance under the whitening matrix of the row's group."""
    total = F.lit(0.0)
    for i in range(_DIMS):
        z = F.lit(0.0)
        for j in range(i + 1):
            z = z + F.col(f"w{i}_{j}") * (F.col(_NAMES[j]) - F.col(f"m{j}"))
        total = total + z * z
    return total


def _estimates(moments: DataFrame, factor: float) -> DataFrame:
    """Means and whitening matrices from ``grp, start, n``, sums ``s*`` and sums of products ``p*``."""
    floors = np.array(list(FLOORS.values()))
    unit = np.outer(floors, floors)

    def run(frames):
        import pandas as pd

        for frame in frames:
            rows = []
            for row in frame.to_dict("records"):
                mean = np.array([row[f"s{i}"] for i in range(_DIMS)]) / row["n"]
                spread = np.zeros((_DIMS, _DIMS))
                for i, j in _PAIRS:
                    spread[i, j] = spread[j, i] = row[f"p{i}_{j}"] / row["n"] - mean[i] * mean[j]
                values, axes = np.linalg.eigh(spread * factor / unit)
                spread = (axes * np.maximum(values, 1)) @ axes.T * unit
                white = np.linalg.inv(np.linalg.cholesky(spread))
                rows.append([row["grp"], row["start"], *mean, *[white[i, j] for i, j in _PAIRS]])
            yield pd.DataFrame(rows, columns=_ESTIMATE)

    kinds = {"grp": "string", "start": "int"}
    schema = ", ".join(f"{n} {kinds.get(n, 'double')}" for n in _ESTIMATE)
    return moments.mapInPandas(run, schema)


def _bin() -> Column:
    """Distances in steps of a sixteenth of an octave, so that counts give quantiles."""
    return F.floor(16 * F.log2(F.col("d2") + 1e-6)).cast("int")


def _quantile_bin(measured: DataFrame, share: float, keys: list[str]) -> DataFrame:
    """``keys, edge``: the bin up to which a group has at least ``share`` of its rows.

    The counts are exact and cover all rows; a group has a bounded number of bins.
    """
    counts = measured.groupBy(*keys, _bin().alias("bin")).agg(F.count("*").alias("c"))
    group = Window.partitionBy(*keys)
    summed = counts.withColumns(
        {"below": F.sum("c").over(group.orderBy("bin")), "n": F.sum("c").over(group)}
    )
    return summed.where(F.col("below") >= F.ceil(share * F.col("n"))).groupBy(*keys).agg(
        F.min("bin").alias("edge")
    )


def minimum_covariance(rows: DataFrame, steps: int = STEPS, support: float = SUPPORT) -> DataFrame:
    """Per group the minimum-covariance-determinant estimate, as means and a whitening matrix.

    It starts from medians with interquartile ranges and from medians with median absolute deviations.
    Neither is near junk of less than half a group; from starts that are, copies of one vector, a third
    of the rows, would have the smallest determinant. From each start, each step keeps the ``support`` share of rows that are nearest under the last estimate and
    takes their mean and covariance, which never raises the determinant; all rows of all groups take
    part in every step, as partial aggregates. The estimate of the smallest determinant is taken, the
    first start's unless another is ``CLEARLY`` smaller. The covariance is scaled to be consistent for
    normal data and bounded from below by ``FLOORS``.
    """
    middle = [F.percentile_approx(n, [0.25, 0.5, 0.75], 10000).alias(n) for n in _NAMES]
    quartiles = rows.groupBy("grp").agg(*middle)
    ranges = [(F.col(n)[2] - F.col(n)[0]) / 1.349 for n in _NAMES]
    first = materialize(_start(quartiles, 0, [F.col(n)[1] for n in _NAMES], ranges), "estimate")
    far = lookup_join(rows, first, ["grp"]).groupBy("grp").agg(
        *[F.first(f"m{i}").alias(f"c{i}") for i in range(_DIMS)],
        *[F.percentile_approx(F.abs(F.col(n) - F.col(f"m{i}")), 0.5, 10000).alias(n) for i, n in enumerate(_NAMES)],
    )
    centres = [F.col(f"c{i}") for i in range(_DIMS)]
    second = materialize(_start(far, 1, centres, [F.col(n) / 0.6745 for n in _NAMES]), "estimate")
    estimate = materialize(first.union(second), "estimate")
    factor = _consistency(support)
    starts = rows.withColumn("start", F.explode(F.array(F.lit(0), F.lit(1))))
    keys = ["grp", "start"]
    for _ in range(steps):
        measured = lookup_join(starts, estimate, keys).withColumn("d2", _distance())
        measured = measured.select(*keys, "d2", *_NAMES)
        edges = materialize(_quantile_bin(measured, support, keys), "edges")
        near = lookup_join(measured, edges, keys).where(_bin() <= F.col("edge"))
        estimate = materialize(_estimates(_moments(near, keys), factor), "estimate")
    # The whitening matrix is triangular; its diagonal gives the determinant.
    size = -2 * sum((F.log(f"w{i}_{i}") for i in range(_DIMS)), F.lit(0.0))
    rank = F.struct(F.when(F.col("start") == 0, size - CLEARLY).otherwise(size), "start")
    best = estimate.groupBy("grp").agg(F.min_by(F.struct(*_ESTIMATE[2:]), rank).alias("best"))
    return materialize(best.select("grp", "best.*"), "estimate")


def _consistency(share: float) -> float:
    """What makes the covariance of the nearest ``share`` of normal rows that of all."""
    return share / chisquare.cdf(chisquare.quantile(share, _DIMS), _DIMS + 2)


def _moments(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.count("*").alias("n"),
        *[F.sum(n).alias(f"s{i}") for i, n in enumerate(_NAMES)],
        *[F.sum(F.col(_NAMES[i]) * F.col(_NAMES[j])).alias(f"p{i}_{j}") for i, j in _PAIRS],
    )


def _start(groups: DataFrame, start: int, centres: list[Column], spreads: list[Column]) -> DataFrame:
    """An estimate of components apart, their deviations raised to ``FLOORS`` at least."""
    scales = [F.greatest(s, F.lit(FLOORS[n])) for s, n in zip(spreads, _NAMES, strict=True)]
    return groups.select(
        "grp",
        F.lit(start).alias("start"),
        *[c.alias(f"m{i}") for i, c in enumerate(centres)],
        *[(1 / scales[i] if i == j else F.lit(0.0)).alias(f"w{i}_{j}") for i, j in _PAIRS],
    )


def _reweighted(rows: DataFrame, estimate: DataFrame) -> DataFrame:
    """Means and whitening matrices of all rows that are not far under ``estimate``.

    Distances are scaled to the group's median where that exceeds the one of normal data, so at least
    about half of a group takes part.
    """
    measured = lookup_join(rows, estimate, ["grp"]).withColumn("d2", _distance())
    measured = _scaled(measured.select("grp", "d2", *_NAMES))
    near = measured.where(F.col("d2") <= chisquare.quantile(REWEIGHTED, _DIMS) * F.col("scale"))
    found = _estimates(_moments(near.withColumn("start", F.lit(0)), ["grp", "start"]), _consistency(REWEIGHTED))
    return materialize(found.drop("start"), "estimate")


def _scaled(measured: DataFrame) -> DataFrame:
    """Adds ``scale``: how far the group's median distance exceeds that of normal data, or 1."""
    middles = materialize(_quantile_bin(measured, 0.5, ["grp"]), "middles")
    usual = chisquare.quantile(0.5, _DIMS)
    scale = F.greatest(F.pow(F.lit(2.0), (F.col("edge") + 1) / 16) / usual, F.lit(1.0))
    return lookup_join(measured, middles.select("grp", scale.alias("scale")), ["grp"])


def quality_verdicts(
    docs: DataFrame, min_group: int = MIN_GROUP, confidence: float = CONFIDENCE
) -> DataFrame:
    """Per document its statistics, ``base_failed``, squared distances ``d2, judged_d2`` and ``kept``.

    Rows that fail the base rules are rejected and have no distance. For the others, a minimum
    covariance determinant is estimated per language and source over all rows; languages' small
    sources are pooled, and so are small languages. ``d2`` is the distance under it. The verdict is by
    ``judged_d2``, that under the estimate reweighted over all rows not far from it: a group whose median
    distance exceeds that of normal data is judged on that scale, and rows beyond the ``confidence``
    quantile are rejected.

    Null ``lang`` and ``source``, or missing columns, are labels like any other. A null or empty text
    has no words and fails. Each row counts, also with a null or repeated ``doc_id``; other columns
    are ignored. An empty table gives no rows. A task holds about 4 MB of texts, or one longer text with
    its words.
    """
    rows = materialize(_vector(statistics(docs)), "statistics")
    passed = rows.where(~F.col("base_failed"))
    grouped = materialize(lookup_join(passed, _groups(passed, min_group), ["lang", "source"]), "grouped")
    estimate = minimum_covariance(grouped)
    judged = lookup_join(grouped, estimate, ["grp"]).withColumn("d2", _distance())
    judged = judged.select(*rows.columns, "grp", "d2")
    # The best half alone misjudges the tails; the verdict is by all rows that are not far from it.
    names = [c for c in judged.columns if c != "d2"]
    judged = lookup_join(judged.withColumnRenamed("d2", "raw_d2"), _reweighted(grouped, estimate), ["grp"])
    judged = judged.withColumn("d2", _distance()).select(*names, "raw_d2", "d2")
    judged = _scaled(judged).withColumn("judged_d2", F.col("d2") / F.col("scale")).drop("d2")
    judged = judged.withColumnRenamed("raw_d2", "d2")
    judged = judged.withColumn("kept", F.col("judged_d2") <= chisquare.quantile(confidence, _DIMS))
    none = F.lit(None).cast("double")
    failed = rows.where("base_failed").withColumns({"d2": none, "judged_d2": none, "kept": F.lit(False)})
    names = ["doc_id", *STATISTICS, "base_failed", "d2", "judged_d2", "kept"]
    return judged.select(*names).union(failed.select(*names))
