"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(df: DataFrame, key: str | None = None, *, min_partitions: int | None = None) -> DataFrame:
    """Hash-partition ``df`` on ``key`` when its scan yields fewer
    partitions than the cluster can run at once, so that CPU-heavy per-row
    work (regex tokenising of whole texts) uses every core.

    On a cluster reading many files the scan already has more partitions
    than cores and this is a no-op, so no shuffle is added. When it does
    repartition on the title key, later per-title regroups (``groupBy`` on
    that key) reuse the partitioning instead of shuffling again.
    """
    target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)


def right_size(df: DataFrame, rows_per_partition: int = 500_000) -> DataFrame:
    """Merge partitions (no shuffle) of a materialised table that is split
    finer than its size needs: at least one partition per core, otherwise
    about ``rows_per_partition`` rows each.

    Iterative training runs one job per solver iteration over its input;
    hundreds of near-empty partitions would make every iteration pay for
    hundreds of tasks. Meant for checkpointed tables, where the count is
    cheap; a large table keeps its partitions.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    current = df.rdd.getNumPartitions()
    if current <= cores:
        return df
    target = max(cores, -(-df.count() // rows_per_partition))
    return df.coalesce(target) if target < current else df
