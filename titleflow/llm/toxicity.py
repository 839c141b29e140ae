"""Toxicity scores from a factorization machine over hashed terms.

Terms (runs of letters in lower case) are hashed into ``n_hash`` buckets,
present or absent. They feed a factorization machine: a bias, a weight per
bucket and a vector per bucket whose inner products weigh every pair of
buckets, so that two terms together may count for more (or less) than the
sum of both.

Which buckets the machine sees is decided on the data: all that stand in a
number of training rows (``min_docs``, one or more), where it can learn
pairs of terms that tell nothing alone, or only those that depend on the
label by themselves (chi-squared, the error over all buckets held at
``error``), where most terms are noise to a small sample. A machine is
fitted for each choice on four fifths of the training rows; the one with
the smallest log loss on the last fifth is fitted again on all of them.

The model is fitted on a bounded sample of labelled rows (``max_train``
documents, by a hash of their id; equal texts once) and applied to every
whole text inside the JVM: no Python, no shuffle of texts.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import FMClassifier
from pyspark.ml.feature import HashingTF, UnivariateFeatureSelector, VarianceThresholdSelector
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import stored

FOLDS = 5


def held_out(id_col: str) -> Column:
    """True for the fold that no model sees (crc32 of the id as text mod 5
    is 0); null ids are in no fold: false."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


def terms(text: Column) -> Column:
    """Runs of letters in lower case; null and empty texts: none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), "")


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, label: str,
                  max_train: int) -> DataFrame:
    """(terms, label) of at most about ``max_train`` labelled documents
    outside the held-out fold. Repeated labels of an id count as its
    largest, null labels not at all; equal texts are one row."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.max(label).cast("double").alias("label"))
    known = stored(known)
    share = min(1.0, max_train / max(1, known.count()))
    sample = known.where(F.pmod(F.xxhash64(F.lit("train"), id_col), F.lit(1_000_000)) < int(share * 1_000_000))
    # at most about max_train thin rows
    rows = docs.select(id_col, F.coalesce(F.col(text), F.lit("")).alias("__t")).join(F.broadcast(sample), id_col)
    rows = rows.select(terms(F.col("__t")).alias("terms"), "label", F.xxhash64("__t").alias("h"))
    return rows.groupBy("h").agg(F.max_by("terms", "label").alias("terms"), F.max("label").alias("label"))


def _selector(choice: tuple[str, float], n: int):
    """The stage that picks the machine's buckets out of ``n`` rows."""
    kind, value = choice
    if kind == "alone":
        chosen = UnivariateFeatureSelector(featuresCol="hashed", outputCol="features", labelCol="label", selectionMode="fwe")
        return chosen.setFeatureType("categorical").setLabelType("categorical").setSelectionThreshold(value)
    # a bucket that stands in d of n rows has the variance d / n * (1 - d / n), times n / (n - 1)
    share = (value - 0.5) / max(n, 2)
    return VarianceThresholdSelector(featuresCol="hashed", outputCol="features",
                                     varianceThreshold=max(0.0, share * (1 - share)))


def _machine(rows: DataFrame, choice: tuple[str, float], n_hash: int, factors: int, iterations: int,
             seed: int) -> PipelineModel | None:
    """Hashing, selection and machine fitted on ``rows``; None if no bucket is chosen."""
    hashed = HashingTF(numFeatures=n_hash, binary=True, inputCol="terms", outputCol="hashed")
    select = _selector(choice, rows.count()).fit(hashed.transform(rows))
    if not select.selectedFeatures:
        return None
    machine = FMClassifier(labelCol="label", factorSize=factors, maxIter=iterations, stepSize=0.1, regParam=0.002,
                           initStd=0.01, seed=seed)
    return Pipeline(stages=[hashed, select, machine]).fit(rows)


def _log_loss(model: PipelineModel, rows: DataFrame) -> float:
    p = F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), F.get(vector_to_array("probability"), F.lit(1))))
    return model.transform(rows).agg(F.avg(-F.log(F.when(F.col("label") == 1, p).otherwise(1 - p)))).first()[0]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        n_hash: int = 1 << 18, error: float = 0.01, min_docs: tuple[int, ...] = (10,), factors: int = 4,
        max_train: int = 20_000, iterations: int = 60, seed: int = 42) -> PipelineModel | float:
    """The fitted pipeline; where the labels hold one class at most, or no
    bucket is chosen, the share of label 1 (no labels: 0)."""
    rows = stored(training_rows(docs, labels, id_col, text, label, max_train))
    share = rows.agg(F.avg("label")).first()[0] or 0.0
    if share in (0.0, 1.0):
        return share
    few = rows.coalesce(rows.sparkSession.sparkContext.defaultParallelism)
    choices = [("alone", error), *[("rows", n) for n in min_docs]]
    judge = F.pmod(F.xxhash64(F.lit("judge"), "h"), F.lit(5)) == 0
    learn, last = few.where(~judge).drop("h"), few.where(judge).drop("h")
    losses = []
    # a sample too small to hold both classes on either side is not split: the first choice that finds a bucket
    if learn.agg(F.count_distinct("label")).first()[0] == 2 and last.agg(F.count_distinct("label")).first()[0] == 2:
        for i, choice in enumerate(choices):
            model = _machine(learn, choice, n_hash, factors, iterations, seed)
            if model is not None:
                losses.append((_log_loss(model, last), i))
    order = [choices[i] for _, i in sorted(losses)] + choices
    for choice in order:
        model = _machine(few.drop("h"), choice, n_hash, factors, iterations, seed)
        if model is not None:
            return model
    return share


def score(docs: DataFrame, model: PipelineModel | float, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score (probability of label 1),
    predicted. A number as model is every row's score. Null and empty texts get
    the score of a text without terms; other columns are ignored."""
    rows = docs.select(F.col(id_col), held_out(id_col).alias("held_out"), terms(F.col(text)).alias("terms"))
    if isinstance(model, float):
        scored = rows.withColumn("score", F.lit(model))
    else:
        scored = model.transform(rows).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(id_col, "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text",
             label: str = "toxic", **fitting) -> DataFrame:
    """Fit on the labelled rows outside the held-out fold, score all rows."""
    return score(docs, fit(docs, labels, id_col, text, label, **fitting), id_col, text)
