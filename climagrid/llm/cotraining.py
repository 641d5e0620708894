"""Quality classifier by co-training: two views of a page teach each other."""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import FeatureHasher, HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climagrid.sources.scratch import materialize

#: Bound of the labelled rows that the classifiers are fitted on.
LABELLED = 20_000
ROUNDS = 3
#: A pseudo-label must be at least this probable.
CONFIDENT = 0.95
WORD_BUCKETS, PAGE_BUCKETS = 4096, 512
REGULARISATION = 0.01
#: Every so many labelled rows one is held out for calibration.
HELD_OUT = 4

_TEXT_NUMBERS = ("t_length", "t_symbols", "t_capitals", "t_repeats", "t_digits")


def _share(count: Column, total: Column) -> Column:
    return F.log1p(100 * count / F.greatest(total, F.lit(1)))


def _views(docs: DataFrame) -> DataFrame:
    """``doc_id`` with the vectors ``text_view`` and ``page_view``, and a key of each that rows of equal
    vectors share, row by row, in built-ins only.

    The text view has hashed words and rates of the whole text; the page view has source, language,
    and the text's size and number of lines, but nothing of what it says.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))

    def label(name: str) -> Column:
        found = F.col(name).cast("string") if name in docs.columns else F.lit(None)
        return F.coalesce(found, F.lit("\0"))

    words = F.split(F.trim(F.lower(text)), r"[\x20\x09-\x0D]+", -1)
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"), words.alias("words"),
        label("source").alias("source"), label("lang").alias("lang"),
    )
    chars, count = F.char_length("text"), F.size("words")

    def without(pattern: str) -> Column:
        return chars - F.char_length(F.regexp_replace("text", pattern, ""))

    size = F.floor(2 * F.log1p(chars)).cast("string")
    lines = chars - F.char_length(F.replace("text", F.lit("\n"), F.lit("")))
    rows = rows.withColumns(
        {
            "t_length": F.log1p(chars / count),
            "t_symbols": _share(without("[#*$%&|<>!]+"), count),
            "t_capitals": _share(without("[A-Z]+"), chars),
            "t_repeats": _share(count - F.size(F.array_distinct("words")), count),
            "t_digits": _share(without("[0-9]+"), chars),
            "p_size": size,
            "p_lines": F.floor(2 * F.log1p(lines)).cast("string"),
            "p_source_lang": F.concat_ws("\1", "source", "lang"),
        }
    )
    hashed = HashingTF(inputCol="words", outputCol="t_words", numFeatures=WORD_BUCKETS, binary=True)
    text_view = VectorAssembler(inputCols=[*_TEXT_NUMBERS, "t_words"], outputCol="text_view")
    page_view = FeatureHasher(
        inputCols=["source", "lang", "p_size", "p_lines", "p_source_lang"],
        outputCol="page_view", numFeatures=PAGE_BUCKETS,
    )
    keys = {"text_view_key": F.xxhash64("text"), "page_view_key": F.xxhash64("source", "lang", "p_size", "p_lines")}
    return page_view.transform(text_view.transform(hashed.transform(rows.withColumns(keys)))).select(
        "doc_id", "text_view", "page_view", *keys
    )


def _fit(rows: DataFrame, view: str) -> LogisticRegressionModel:
    return LogisticRegression(
        featuresCol=view, labelCol="label", rawPredictionCol=f"raw_{view}",
        probabilityCol=f"p_{view}", predictionCol=f"y_{view}",
        weightCol="weight", regParam=REGULARISATION, maxIter=50, aggregationDepth=2,
    ).fit(rows)


def _scored(model: LogisticRegressionModel, rows: DataFrame, view: str, name: str) -> DataFrame:
    """Adds the view's log-odds of class 1 as ``name``."""
    scored = model.transform(rows)
    odds = F.get(vector_to_array(f"raw_{view}"), F.lit(1))
    return scored.withColumn(name, odds).drop(f"raw_{view}", f"p_{view}", f"y_{view}")


def _first(rows: DataFrame, limit: int) -> DataFrame:
    """A bounded sample that depends on the ids only."""
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)


def _lesson(pool: DataFrame, model: LogisticRegressionModel, teacher: str, view: str) -> DataFrame:
    """All rows that the teacher is sure of: the other ``view`` with ``label``."""
    least, odds = F.lit(CONFIDENT / (1 - CONFIDENT)), F.col("odds")
    label = F.when(F.exp(odds) >= least, 1.0).when(F.exp(-odds) >= least, 0.0)
    judged = _scored(model, pool, teacher, "odds").withColumn("label", label)
    return judged.where("label IS NOT NULL").select(view, "label", *[c for c in (f"{view}_key",) if c in pool.columns])


def _folded(lesson: DataFrame, view: str) -> DataFrame:
    """Rows of one vector and label as one row that weighs as much: the same fit over fewer rows.

    Pages have few different vectors, texts as many as there are different texts.
    """
    folded = lesson.groupBy(f"{view}_key", "label").agg(F.first(view).alias(view), F.sum("weight").alias("weight"))
    return folded.select(view, "label", "weight")


def _weighed(lesson: DataFrame, train: DataFrame) -> DataFrame:
    """Adds ``weight``: a class of the lesson weighs at most what it does among the labelled rows."""
    taught = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    found = {r["label"]: r["count"] for r in lesson.groupBy("label").count().collect()}
    weight = {c: min(1.0, taught.get(c, 0) / found[c]) for c in found}
    return lesson.withColumn(
        "weight", F.when(F.col("label") == 1, weight.get(1.0, 0.0)).otherwise(weight.get(0.0, 0.0))
    )


def quality_scores(
    docs: DataFrame, labels: DataFrame, target: str = "quality", rounds: int = ROUNDS
) -> DataFrame:
    """``doc_id, text_score, page_score, score, kept``: the probability of ``target`` for every row.

    A classifier of the text's content and one of the page's metadata are fitted on labelled rows.
    In each round both score all unlabelled rows, and every row that one view is sure of becomes a label
    for the other; a class of them weighs at most as much as among the labelled rows, and rows of equal
    vectors are folded into one that weighs as much. At the end each view's log-odds are calibrated on
    held-out labelled rows (a logistic regression of its own), and another over both combines them; on
    the fitted rows where the held-out ones lack a class.

    The fits use at most ``LABELLED`` labelled rows, chosen by hash of the id, and all unlabelled ones.
    Scores cover all rows and whole texts. Rows whose label is null are unlabelled. If labelled documents
    of one class, or any, are missing, every score is the share of class 1 among them (0.5 without any).

    Null texts are empty; null ids are scored but never used for fitting; repeated ids each give a
    row, and where such an id is labelled, its row of the smallest hash is fitted on. Null or missing
    ``source`` and ``lang`` are values like others. Other columns are ignored; an empty table gives no
    rows. A task holds a row at a time, a very long text with the list of its words.
    """
    known = labels.where(f"doc_id IS NOT NULL AND {target} IS NOT NULL")
    known = known.groupBy(F.col("doc_id").cast("bigint").alias("label_id")).agg(
        F.max(F.col(target).cast("double")).alias("label")
    )
    chosen = materialize(_first(known.withColumnRenamed("label_id", "doc_id"), LABELLED), "labelled-ids")
    # The vectors of all rows are kept once, for every round and for the scores at the end.
    vectors = materialize(_views(docs), "vectors")
    picked = vectors.join(F.broadcast(chosen), "doc_id")
    named = [c for c in picked.columns if c != "doc_id"]
    first = F.min_by(F.struct(*named), F.struct("text_view_key", "page_view_key"))
    picked = picked.groupBy("doc_id").agg(first.alias("row")).select("doc_id", "row.*")
    labelled = materialize(picked.withColumn("weight", F.lit(1.0)).coalesce(8), "sample")
    sums = labelled.agg(F.count("*"), F.sum("label")).first()
    if not sums[0] or sums[1] in (0, sums[0]):
        share = sums[1] / sums[0] if sums[0] else 0.5
        fixed = [F.lit(share).alias(n) for n in ("text_score", "page_score", "score")]
        return docs.select(F.col("doc_id").cast("bigint"), *fixed, F.lit(share >= 0.5).alias("kept"))
    held_out = F.pmod(F.xxhash64(F.lit("held out"), "doc_id"), F.lit(HELD_OUT)) == 0
    train, held = labelled.where(~held_out), labelled.where(held_out)
    if train.select("label").distinct().count() < 2:
        train = labelled
    pool = vectors.where("doc_id IS NOT NULL").join(known, F.col("doc_id") == F.col("label_id"), "left_anti")
    pool = materialize(pool, "pool")

    models = {view: _fit(train, view) for view in ("text_view", "page_view")}
    for _ in range(rounds):
        lessons = {}
        for view, teacher in (("text_view", "page_view"), ("page_view", "text_view")):
            lesson = materialize(_lesson(pool, models[teacher], teacher, view), "lesson")
            taught = materialize(_folded(_weighed(lesson, train), view), "folded-lesson")
            # A row taught before is not added again: each round's lesson replaces the last one.
            own = train.select(view, "label", "weight")
            lessons[view] = own.unionByName(taught)
        models = {view: _fit(rows, view) for view, rows in lessons.items()}

    odds = ["odds_text_view", "odds_page_view"]
    proof = held if held.select("label").distinct().count() == 2 else train
    for view, model in models.items():
        proof = _scored(model, proof, view, f"odds_{view}")
    proof = materialize(proof.select("label", *odds), "calibration")

    def calibrated(columns: list[str]) -> Column:
        """The probability of class 1 by a logistic regression over ``columns``."""
        joined = VectorAssembler(inputCols=columns, outputCol="x").transform(proof)
        model = LogisticRegression(featuresCol="x", labelCol="label", regParam=0.001).fit(joined)
        total = F.lit(float(model.intercept))
        for weight, column in zip(model.coefficients, columns, strict=True):
            total = total + float(weight) * F.col(column)
        return 1 / (1 + F.exp(-total))

    scored = vectors
    for view, model in models.items():
        scored = _scored(model, scored, view, f"odds_{view}")
    scores = scored.select(
        "doc_id",
        calibrated(odds[:1]).alias("text_score"),
        calibrated(odds[1:]).alias("page_score"),
        calibrated(odds).alias("score"),
    )
    return scores.withColumn("kept", F.col("score") >= 0.5)
