"""Distributed classifiers on Spark ML.

The reference fine-tunes single-machine networks; here the user-level
capability - train a classifier from titles, token vectors or cover
images, score a table, combine two models, evaluate - runs on MLlib, whose
training is distributed. Scoring is ``model.transform`` (no driver loop,
no per-batch append); logits come back as ``array<double>``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes
from pyspark.ml.feature import CountVectorizer, HashingTF, IDF
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.functions.arrays import argmax, cross_entropy, multiply, softmax
from titleflow.functions.text import tokenize_basic
from titleflow.operators.partitioning import right_size
from titleflow.session import cut_lineage


@dataclass
class TitleClassifier:
    """A fitted title model: the basic_english tokeniser (a native
    expression) in front of a ``PipelineModel`` (hashing TF -> IDF ->
    multinomial logistic regression)."""

    pipeline: PipelineModel
    text: str = "Title"
    tokens: str = "__tf_tokens"

    def transform(self, df: DataFrame) -> DataFrame:
        return self.pipeline.transform(df.withColumn(self.tokens, tokenize_basic(self.text)))

    def save(self, path: str) -> None:
        self.pipeline.write().overwrite().save(path)

    @classmethod
    def load(cls, path: str, text: str = "Title") -> "TitleClassifier":
        return cls(PipelineModel.load(path), text)


def title_estimator(*, tokens: str = "__tf_tokens", label: str = "Genre",
                    num_features: int = 1 << 18, max_iter: int = 50,
                    reg_param: float = 0.0, elastic_net: float = 0.0) -> Pipeline:
    tf = HashingTF(inputCol=tokens, outputCol="__tf_tf", numFeatures=num_features)
    idf = IDF(inputCol="__tf_tf", outputCol="features")
    lr = LogisticRegression(featuresCol="features", labelCol=label, family="multinomial",
                            maxIter=max_iter, regParam=reg_param, elasticNetParam=elastic_net)
    return Pipeline(stages=[tf, idf, lr])


def fit_title(df: DataFrame, *, text: str = "Title", label: str = "Genre",
              materialize: bool = True, **params) -> TitleClassifier:
    """Train a title classifier (M1).

    Fitting reads the training table several times (IDF document
    frequencies, label statistics, the solver's cached blocks); with
    ``materialize`` the two needed columns are written once to the
    checkpoint folder so that upstream work (splits, joins) is not redone
    for each pass.
    """
    tokens = "__tf_tokens"
    est = title_estimator(tokens=tokens, label=label, **params)
    if not materialize:
        data = df.select(tokenize_basic(text).alias(tokens), F.col(label).cast("double").alias(label))
        return TitleClassifier(est.fit(data), text, tokens)
    # hashed term counts are written, not the texts: no second copy of the
    # corpus, and no pass tokenises it again
    hashing, *rest = est.getStages()
    counts = hashing.transform(df.select(tokenize_basic(text).alias(tokens),
                                         F.col(label).cast("double").alias(label)))
    data = right_size(cut_lineage(counts.drop(tokens)))
    fitted = Pipeline(stages=rest).fit(data)
    return TitleClassifier(PipelineModel(stages=[hashing, *fitted.stages]), text, tokens)


def fit_naive_bayes(df: DataFrame, *, text: str = "Title", label: str = "Genre",
                    smoothing: float = 1.0, vocab_size: int | None = None) -> TitleClassifier:
    """Train a multinomial naive Bayes title classifier (M1) on token
    counts: one pass counts the distinct tokens, one makes the vocabulary of
    all of them, one the counts per class. The model holds a weight per
    token and class. ``vocab_size`` is a limit that the caller may set: more
    distinct tokens raise instead of falling out of the model."""
    tokens = "__tf_tokens"
    data = cut_lineage(df.select(tokenize_basic(text).alias(tokens), F.col(label).cast("double").alias(label)))
    found = data.select(F.explode(tokens).alias("t")).agg(F.count_distinct("t")).first()[0]
    if vocab_size is not None and found > vocab_size:
        raise ValueError(f"{found} distinct tokens, but vocab_size is {vocab_size}")
    counts = CountVectorizer(inputCol=tokens, outputCol="features", vocabSize=max(1, found), minDF=1.0)
    bayes = NaiveBayes(featuresCol="features", labelCol=label, modelType="multinomial", smoothing=smoothing)
    return TitleClassifier(Pipeline(stages=[counts, bayes]).fit(data), text, tokens)


def vector_features(df: DataFrame, features: str, out: str = "features") -> DataFrame:
    """``array<float|double>`` column -> ML vector column."""
    return df.withColumn(out, array_to_vector(F.col(features).cast("array<double>")))


def vector_estimator(layers: list[int], *, label: str = "Genre", max_iter: int = 100,
                     seed: int = 42, block_size: int = 128, solver: str = "l-bfgs",
                     step_size: float = 0.03) -> MultilayerPerceptronClassifier:
    """MLP with the given layer sizes; ``block_size`` is MLlib's stacking
    size, not an SGD batch size, and ``step_size`` only applies to
    ``solver='gd'``."""
    return MultilayerPerceptronClassifier(featuresCol="features", labelCol=label, layers=layers,
                                          maxIter=max_iter, seed=seed, blockSize=block_size,
                                          solver=solver, stepSize=step_size)


def fit_vectors(df: DataFrame, features: str, layers: list[int], *, label: str = "Genre",
                materialize: bool = True, **params):
    """Train on a fixed-length numeric array per row (M2): mean token
    vector, a flattened title matrix, or any model output. ``materialize``
    as in :func:`fit_title`."""
    data = df.select(features, F.col(label).cast("double").alias(label))
    if materialize:
        data = right_size(cut_lineage(data))
    return vector_estimator(layers, label=label, **params).fit(vector_features(data, features))


def fit_image(df: DataFrame, features: str = "pooled", *, label: str = "Genre",
              max_iter: int = 100, reg_param: float = 0.0):
    """Train a cover-image classifier (M3) on pooled, normalised pixels
    (see :func:`titleflow.operators.images.pool`)."""
    data = vector_features(df, features).withColumn(label, F.col(label).cast("double"))
    lr = LogisticRegression(featuresCol="features", labelCol=label, family="multinomial",
                            maxIter=max_iter, regParam=reg_param)
    return lr.fit(data)


def score(model, df: DataFrame, *, features: str | None = None, keep: list[str] | None = None
          ) -> DataFrame:
    """Score a table (M4): adds ``z`` (raw outputs as ``array<double>``)
    and ``pred`` (int). For vector models pass the array column in
    ``features``."""
    data = vector_features(df, features) if features else df
    out = model.transform(data)
    cols = keep if keep is not None else [c for c in df.columns]
    return out.select(*cols, vector_to_array("rawPrediction").alias("z"),
                      F.col("prediction").cast("int").alias("pred"))


def _combine(za, zb, mode: str):
    if mode not in ("raw", "probability"):
        raise ValueError("mode must be 'raw' or 'probability'")
    return multiply(za, zb) if mode == "raw" else multiply(softmax(za), softmax(zb))


def ensemble(a: DataFrame, b: DataFrame, *, on: str = "Id", z: str = "z",
             mode: str = "raw") -> DataFrame:
    """Combine two models' score tables per row (M5, J5): join on the key,
    elementwise product, argmax. ``mode='raw'`` multiplies raw outputs as
    the reference does (two negative scores make a positive one);
    ``mode='probability'`` multiplies softmax probabilities instead."""
    prod = _combine(F.col("z_a"), F.col("z_b"), mode)
    j = a.select(on, F.col(z).alias("z_a")).join(b.select(on, F.col(z).alias("z_b")), on=on)
    return j.select(on, argmax("z_a").alias("pred_a"), argmax("z_b").alias("pred_b"),
                    prod.alias("z"), argmax(prod).alias("pred"))


def ensemble_columns(df: DataFrame, za: str, zb: str, *, mode: str = "raw") -> DataFrame:
    """:func:`ensemble` for two outputs already in the same row (scored by
    one pass over the same table): no join, no shuffle."""
    prod = _combine(F.col(za), F.col(zb), mode)
    return df.withColumn("pred_a", argmax(za)).withColumn("pred_b", argmax(zb)) \
        .withColumn("z_ens", prod).withColumn("pred", argmax(prod))


def evaluate(model, df: DataFrame, size: int, *, key: str = "Id", label: str = "Genre",
             features: str | None = None, digits: int | None = None) -> DataFrame:
    """Validation after a fit (M6): batch-mean accuracy and batch-mean loss
    over batches of ``size`` rows in key order, plus the plain accuracy."""
    from titleflow.operators.sampling import with_batch, with_position
    s = score(model, df, features=features, keep=[key, label])
    s = s.select(key, (F.col("pred") == F.col(label)).cast("double").alias("c"),
                 cross_entropy("z", label).alias("loss"))
    # the per-row results are three narrow columns; writing them once keeps
    # the position index's passes from re-running the model
    per = with_batch(with_position(s, key, materialize=True), size).groupBy("batch_id").agg(
        F.avg("c").alias("acc"), F.avg("loss").alias("l"),
        F.sum("c").alias("sc"), F.count(F.lit(1)).alias("m"))

    def r(c):
        return c if digits is None else F.round(c, digits)
    return per.agg(F.count(F.lit(1)).alias("n_batches"),
                   r(F.avg("acc")).alias("val_accuracy"),
                   r(F.avg("l")).alias("val_loss"),
                   r(F.sum("sc") / F.sum("m")).alias("accuracy"))


def _score_all(models: list, rows: DataFrame, keep: list[str], out: str) -> DataFrame:
    """``keep``, ``out`` (place in ``models``) and ``z`` for every row and
    model, all models in one pass over ``rows`` (its ``features``)."""
    for i, model in enumerate(models):
        rows = model.copy().setRawPredictionCol(f"__tf_z{i}").setProbabilityCol("").setPredictionCol("").transform(rows)
    return rows.select(*keep, F.posexplode(F.array(*[
        vector_to_array(f"__tf_z{i}") for i in range(len(models))])).alias(out, "z"))


def evaluate_all(models: list, df: DataFrame, size: int, *, features: str, key: str = "Id", label: str = "Genre",
                 digits: int | None = None) -> DataFrame:
    """:func:`evaluate` of several vector models: one row per model with its
    place ``model`` in the list (from 0). The batches are made once and one
    scan scores every model, so a search over k settings doesn't read the
    validation table k times. No models are refused; a table without rows
    gives no rows."""
    from titleflow.operators.sampling import with_batch, with_position
    if not models:
        raise ValueError("no models to evaluate")
    rows = with_batch(with_position(df.select(key, features, label), key, out="__tf_pos", materialize=True), size,
                      pos="__tf_pos")
    each = _score_all(models, vector_features(cut_lineage(rows.select("batch_id", features, label)), features),
                      ["batch_id", label], "model")
    each = each.select("model", "batch_id", (argmax("z") == F.col(label)).cast("double").alias("c"),
                       cross_entropy("z", F.col(label).cast("int")).alias("loss"))
    per = each.groupBy("model", "batch_id").agg(F.avg("c").alias("acc"), F.avg("loss").alias("l"), F.sum("c").alias("sc"),
                                                F.count(F.lit(1)).alias("m"))

    def r(c):
        return c if digits is None else F.round(c, digits)
    return per.groupBy("model").agg(F.count(F.lit(1)).alias("n_batches"), r(F.avg("acc")).alias("val_accuracy"),
                                    r(F.avg("l")).alias("val_loss"), r(F.sum("sc") / F.sum("m")).alias("accuracy"))


def fit_epochs(train: DataFrame, validation: DataFrame, features: str, layers: list[int], *, epochs: int, size: int,
               key: str = "Id", label: str = "Genre", iterations: int = 5, seed: int = 42,
               run_id: str = "run") -> tuple[list, DataFrame]:
    """Train in ``epochs`` rounds and evaluate after each (M6, A4, S12).

    Every round goes on from the weights of the one before for
    ``iterations`` solver steps. Returns the model of each round and the
    metric log ``(run_id, epoch, step, metric, value)``, epochs from 1, with
    ``avg_train_loss`` (mean over the epoch's own batches of the training
    rows, in an order that is permuted anew each epoch), ``avg_val_loss``
    and ``val_accuracy`` (batches in key order).

    Both tables are written once with their row numbers. All models are
    evaluated in a single scan of either table. Tables without rows have no
    log rows of their metrics; rows whose label is outside the outputs fail.
    """
    from titleflow.operators.permutation import permuted
    from titleflow.operators.sampling import with_position
    if epochs <= 0 or size <= 0:
        raise ValueError("epochs and batch size must be positive")
    tables = []
    for df in (train, validation):
        rows = df.select(key, F.col(features).alias("__tf_x"), F.col(label).cast("double").alias(label))
        tables.append(right_size(cut_lineage(vector_features(with_position(rows, key, out="__tf_pos", materialize=True), "__tf_x")
                                             .select("__tf_pos", "features", label))))
    models, weights = [], None
    for _ in range(epochs):
        est = vector_estimator(layers, label=label, max_iter=iterations, seed=seed)
        model = (est if weights is None else est.setInitialWeights(weights)).fit(tables[0])
        weights = model.weights
        models.append(model)

    def losses(rows: DataFrame, reorder: bool) -> DataFrame:
        """(epoch, loss, right): means over the epoch's batches."""
        n = rows.count()
        each = _score_all(models, rows, ["__tf_pos", label], "__tf_e")
        place = permuted("__tf_pos", n, seed, "__tf_e") if reorder else F.col("__tf_pos")
        loss = cross_entropy("z", F.col(label).cast("int"))
        each = each.select((F.col("__tf_e") + 1).alias("epoch"), F.floor(place / size).alias("batch"),
                           F.coalesce(loss, F.raise_error(F.lit("label outside the outputs")).cast("double")).alias("loss"),
                           (argmax("z") == F.col(label)).cast("double").alias("right"))
        return each.groupBy("epoch", "batch").agg(F.avg("loss").alias("loss"), F.avg("right").alias("right")).groupBy(
            "epoch").agg(F.avg("loss").alias("loss"), F.avg("right").alias("right"))

    def named(rows: DataFrame, metric: str, value: str) -> DataFrame:
        return rows.select(F.lit(run_id).alias("run_id"), F.col("epoch").cast("int").alias("epoch"),
                           F.lit(None).cast("long").alias("step"), F.lit(metric).alias("metric"), F.col(value).alias("value"))

    # fixed values: names of the three epoch statistics
    val = cut_lineage(losses(tables[1], False))
    log = named(losses(tables[0], True), "avg_train_loss", "loss").unionByName(
        named(val, "avg_val_loss", "loss")).unionByName(named(val, "val_accuracy", "right"))
    return models, cut_lineage(log)


def training_history(model) -> list[float]:
    """Per-iteration objective of the last fit (driver-side: one number per
    solver iteration)."""
    summary = getattr(model, "summary", None)
    if summary is None and hasattr(model, "stages"):
        summary = getattr(model.stages[-1], "summary", None)
    return list(summary.objectiveHistory) if summary is not None else []
