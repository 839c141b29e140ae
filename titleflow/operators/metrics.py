"""Evaluation metrics.

Every metric is an aggregate returning a small DataFrame; the caller shows
or writes it. Ratios keep the reference's operation order
``100.0 * (correct / total)``; ``digits`` rounds for display and for
engine-independent comparison.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.operators.sampling import with_batch, with_position


def _round(c, digits):
    return c if digits is None else F.round(c, digits)


def with_truth(pred: DataFrame, truth: DataFrame, *, on: str = "Id",
               pred_col: str = "pred", label: str = "Genre") -> DataFrame:
    """Prediction joined to ground truth on the key, with ``correct`` (0/1).

    Both sides are keyed 1:1; a sort-merge join on ``on`` (or a broadcast
    one when AQE sees a small side at run time).
    """
    j = pred.join(truth.select(on, label), on=on, how="inner")
    return j.withColumn("correct", (F.col(pred_col) == F.col(label)).cast("int"))


def row_count(df: DataFrame, out: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(out))


def accuracy(df: DataFrame, *, pred_col: str = "pred", label: str = "Genre",
             digits: int | None = None) -> DataFrame:
    """Overall accuracy in percent: one row ``n, n_correct, accuracy``."""
    correct = F.sum((F.col(pred_col) == F.col(label)).cast("long"))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n"), correct.alias("n_correct"),
                  _round(F.lit(100.0) * (correct / n), digits).alias("accuracy"))


def per_class_accuracy(df: DataFrame, n_classes: int = 30, *,
                       pred_col: str = "pred", label: str = "Genre",
                       digits: int | None = None) -> DataFrame:
    """Accuracy per true class for every class 0..n_classes-1.

    A class without rows is listed with ``n = 0`` and NULL accuracy (the
    reference divides by zero there). Rows whose label is NULL or outside
    the classes, if there are any, are counted in one more row with class
    -1, so that ``n`` always adds up to all rows. The data is reduced by a
    partial + final ``groupBy`` first (a hot class only adds to its
    map-side counters); the class list is ``range(n_classes)`` joined to
    that result.
    """
    known = F.col(label).between(0, n_classes - 1)
    per = df.groupBy(F.when(known, F.col(label)).otherwise(-1).cast("int").alias("class")).agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum((F.col(pred_col) == F.col(label)).cast("long")), F.lit(0)).alias("n_correct"))
    classes = df.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("class"))
    out = classes.join(per, on="class", how="left").unionByName(per.where("class = -1"))
    n = F.coalesce(F.col("n"), F.lit(0)).cast("long")
    c = F.coalesce(F.col("n_correct"), F.lit(0)).cast("long")
    return out.select(
        "class", n.alias("n"), c.alias("n_correct"),
        _round(F.lit(100.0) * F.try_divide(c, n.cast("double")), digits).alias("accuracy"))


def batch_mean_accuracy(df: DataFrame, size: int, *, order_by: str = "Id",
                        pred_col: str = "pred", label: str = "Genre", seed=None,
                        digits: int | None = None) -> DataFrame:
    """Mean over batches of each batch's accuracy (a fraction, as
    ``flat_accuracy``): batches of ``size`` rows in ``order_by`` order (or
    md5 order with ``seed``); the last batch may be short and counts as one
    batch, which is why this differs from :func:`accuracy`."""
    pos = with_batch(with_position(df, order_by, seed=seed), size)
    per_batch = pos.groupBy("batch_id").agg(
        F.avg((F.col(pred_col) == F.col(label)).cast("double")).alias("acc"))
    return per_batch.agg(F.count(F.lit(1)).alias("n_batches"),
                         _round(F.avg("acc"), digits).alias("batch_mean_accuracy"))


def batch_mean_loss(df: DataFrame, size: int, *, loss: str = "loss",
                    order_by: str = "Id", seed=None,
                    digits: int | None = None) -> DataFrame:
    """Unweighted mean over batches of each batch's mean loss, next to the
    row-weighted mean. A row without a loss (a label outside the model's
    outputs has none) fails the query instead of bending both means."""
    pos = with_batch(with_position(df, order_by, seed=seed), size)
    per_batch = pos.groupBy("batch_id").agg(F.avg(loss).alias("l"),
                                            F.count(F.lit(1)).alias("m"),
                                            F.count(loss).alias("known"),
                                            F.sum(loss).alias("s"))
    lost = F.sum(F.col("m") - F.col("known"))
    message = F.concat(lost.cast("string"), F.lit(" rows without a loss: label outside the outputs?"))
    return per_batch.agg(
        F.count(F.lit(1)).alias("n_batches"),
        F.when(lost > 0, F.raise_error(message)).otherwise(
            _round(F.sum("s") / F.sum("m"), digits)).alias("mean_loss"),
        _round(F.avg("l"), digits).alias("batch_mean_loss"))


def metric_log(df: DataFrame, *, run_id, epoch, step, metric, value) -> DataFrame:
    """Normalise any table into the metric-log shape
    ``run_id string, epoch int, step long, metric string, value double``."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x
    return df.select(c(run_id).cast("string").alias("run_id"),
                     c(epoch).cast("int").alias("epoch"),
                     c(step).cast("long").alias("step"),
                     c(metric).cast("string").alias("metric"),
                     c(value).cast("double").alias("value"))


def epoch_history(log: DataFrame, metrics: dict[str, str] | None = None, *,
                  digits: int | None = None) -> DataFrame:
    """One row per epoch with the average of each chosen metric.

    ``metrics`` maps an output column to a metric name in the log; the
    default is the reference's three epoch statistics.
    """
    # fixed values: names of the three epoch statistics and their metrics
    metrics = metrics or {"training_loss": "avg_train_loss",
                          "valid_loss": "avg_val_loss",
                          "valid_accur": "val_accuracy"}
    names = list(dict.fromkeys(metrics.values()))
    piv = (log.where(F.col("metric").isin(names))
           .groupBy("epoch").pivot("metric", names).agg(F.avg("value")))
    return piv.select(F.col("epoch").cast("int").alias("epoch"),
                      *[_round(F.col(f"`{m}`"), digits).alias(out)
                        for out, m in metrics.items()])


def sample_log(log: DataFrame, every: int, *, step: str = "step") -> DataFrame:
    """The periodic progress report: log rows whose ``step + 1`` is a
    multiple of ``every`` (the reference prints every 500th batch)."""
    if every <= 0:
        raise ValueError("every must be positive")
    return log.where(((F.col(step) + 1) % every) == 0)


def summarise(df: DataFrame, columns: Sequence[str], digits: int = 2) -> DataFrame:
    """Numbers formatted for a console report (``%.<digits>f``)."""
    return df.select(*[F.format_string(f"%.{digits}f", F.col(c)).alias(c) for c in columns])
