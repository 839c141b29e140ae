"""Hyper-parameter search.

A seeded random sample of ``k`` points from a ``ParamGridBuilder`` grid is
fitted with ``Estimator.fitMultiple`` (each fit is a distributed MLlib
job, some of them at a time), the models are evaluated on the fixed
validation table, all in one scan of it where the caller gives a function
that can, and the results form a small DataFrame (one row per run). The training and
validation tables are checkpointed once to the shared checkpoint folder
so the repeated fits neither recompute the upstream plan nor depend on a
lost executor's cache.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

ParamMap = dict  # a parameter map is a plain {Param: value} dict in PySpark
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleflow.operators.sampling import sample_param_maps
from titleflow.session import cut_lineage


def _describe(pm: ParamMap) -> str:
    return ", ".join(f"{p.name}={v}" for p, v in sorted(pm.items(), key=lambda kv: kv[0].name))


def random_search(estimator, grid: Sequence[ParamMap], train: DataFrame, val: DataFrame,
                  k: int, seed: int, *,
                  evaluate: Callable[[object, DataFrame], DataFrame] | None = None,
                  evaluate_all: Callable[[list, DataFrame], DataFrame] | None = None,
                  defaults: ParamMap | None = None, checkpoint: bool = True,
                  parallelism: int = 1) -> DataFrame:
    """Fit ``k`` sampled settings and evaluate each one.

    ``evaluate_all(models, val)`` returns one row of metrics per model with
    its place ``model`` in the list, from one scan of ``val`` (for example
    :func:`titleflow.operators.models.evaluate_all`); ``evaluate(model,
    val)`` a one-row DataFrame for one model, which reads ``val`` once per
    model. One of them is given; its other columns become the result
    columns, next to ``run_id`` and ``params``. Up to ``parallelism`` fits
    run at a time; set ``spark.scheduler.mode`` to FAIR to share executors
    evenly between them. An empty grid runs the ``defaults`` once. ``k`` is
    mandatory: the search always ends.
    """
    if k <= 0 or parallelism <= 0:
        raise ValueError("k and parallelism must be positive")
    if (evaluate is None) == (evaluate_all is None):
        raise ValueError("give either evaluate or evaluate_all")
    maps = list(grid) or [{}]
    chosen = sample_param_maps(maps, k, seed)
    if defaults:
        chosen = [{**defaults, **m} for m in chosen]
    if checkpoint:
        train, val = cut_lineage(train), cut_lineage(val)
    spark: SparkSession = train.sparkSession
    fits = estimator.fitMultiple(train, chosen)
    fit_next = inheritable_thread_target(spark)(lambda _: next(fits))
    with ThreadPool(min(parallelism, len(chosen))) as pool:
        fitted = dict(pool.imap_unordered(fit_next, range(len(chosen))))
    models = [fitted[i] for i in range(len(chosen))]
    if evaluate_all is not None:
        found = {r["model"]: r for r in evaluate_all(models, val).collect()}  # one row per model
        metrics = [{c: v for c, v in found[i].asDict().items() if c != "model"} for i in sorted(found)]
        runs = sorted(found)
    else:
        metrics, runs = [evaluate(m, val).first().asDict() for m in models], range(len(models))
    if not metrics:
        raise ValueError("the validation table has no rows")
    rows = [(f"run-{i:03d}", _describe(chosen[i]), *m.values()) for i, m in zip(runs, metrics)]
    return spark.createDataFrame(rows, ["run_id", "params", *metrics[0]])


def best_run(results: DataFrame, metric: str = "val_accuracy", *, run_col: str = "run_id",
             maximise: bool = True) -> DataFrame:
    """The single best run (top-1 by the metric, ties to the smallest run
    id). A distributed take-ordered: each partition keeps its best row."""
    order = F.desc(metric) if maximise else F.asc(metric)
    return results.where(F.col(metric).isNotNull()).orderBy(order, F.asc(run_col)).limit(1)
