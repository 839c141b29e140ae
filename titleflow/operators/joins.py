"""Joins.

``align_labels`` replaces the reference's positional pairing of a feature
file and a label file by a key join with explicit key checks.
``lookup_join`` is the one place that decides how a token stream meets a
lookup table (vocabulary, vectors, lemmas): broadcast when the table's row
count is checked to be under a bound, otherwise a salted shuffle join so
that a hot token (``the`` can be a large share of all tokens) is spread
over several tasks instead of one.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.session import cut_lineage

# Lookup tables up to this many rows are broadcast (a vocabulary of 50k
# words, or 300-dim vectors for ~200k words, stays well under 1 GB).
DEFAULT_MAX_BROADCAST_ROWS = 200_000


class KeyCheckError(ValueError):
    pass


def _bad_key(df: DataFrame, on: str):
    """One aggregate over the key column: a NULL key or a repeated key (the
    first one found), else None."""
    bad = (df.groupBy(on).agg(F.count(F.lit(1)).alias("__tf_n"))
           .where(F.col(on).isNull() | (F.col("__tf_n") > 1)).limit(1).collect())
    if not bad:
        return None
    return "NULL" if bad[0][on] is None else "duplicate"


def check_keys(x: DataFrame, y: DataFrame, on: str = "Id", *, equal: bool = True) -> None:
    """Raise :class:`KeyCheckError` when a key is NULL or repeated on either
    side, or (``equal``) when a key is present on one side only.

    Each check is a distributed aggregate returning a count; nothing but the
    count reaches the driver.
    """
    for name, d in (("features", x), ("labels", y)):
        kind = _bad_key(d, on)
        if kind:
            raise KeyCheckError(f"{name}: {kind} {on}")
    if equal:
        kx, ky = x.select(on), y.select(on)
        if kx.join(ky, on, "left_anti").limit(1).count():
            raise KeyCheckError(f"features have {on} values without a label")
        if ky.join(kx, on, "left_anti").limit(1).count():
            raise KeyCheckError(f"labels have {on} values without features")


def align_labels(x: DataFrame, y: DataFrame, on: str = "Id", how: str = "inner",
                 check: bool | str = True) -> DataFrame:
    """Pair every feature row with its label row by key.

    ``how='inner'`` keeps labelled rows, ``how='left'`` keeps all feature
    rows with a NULL label where none exists (the optional-label branch).
    ``check=True`` demands unique keys on both sides and, for an inner
    join, equal key sets (the reference pairs rows by position and silently
    mis-pairs otherwise); ``check='unique'`` only demands unique keys;
    ``check=False`` skips the extra jobs.

    A label column that the features have already (the NULL placeholder of
    unlabelled tables, say) takes the label table's value; where that one
    is NULL or missing the features' own value stays.

    ``on='position'`` pairs row i of one file table with row i of the other
    (:func:`titleflow.operators.positional.pair_by_position`): tables as
    their readers returned them, unequal lengths raise for ``'inner'``;
    ``'left'`` leaves features beyond the last label without one.
    """
    if on == "position":
        from titleflow.operators.positional import pair_by_position
        pairs = pair_by_position(x, y, lengths="equal" if how == "inner" else "longest")
        if how == "left" and pairs.where(F.col("pos") >= x.count()).limit(1).count():
            raise KeyCheckError("more labels than features")
        return pairs
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if check:
        check_keys(x, y, on, equal=(check is True and how == "inner"))
    both = [c for c in y.columns if c != on and c in x.columns]
    y = y.withColumnsRenamed({c: f"__tf_y_{c}" for c in both})
    out = x.join(y, on=on, how=how)
    for c in both:
        out = out.withColumn(c, F.coalesce(F.col(f"__tf_y_{c}"), F.col(c)))
    return out.drop(*[f"__tf_y_{c}" for c in both])


def table_rows_at_most(table: DataFrame, bound: int) -> bool:
    """True when ``table`` has at most ``bound`` rows (one counting job that
    stops at ``bound + 1``)."""
    return table.limit(bound + 1).count() <= bound


def hot_keys(df: DataFrame, key: str, *, sample_fraction: float = 0.01,
             hot_share: float = 0.001, seed: int = 7) -> DataFrame:
    """Keys that hold at least ``hot_share`` of the rows of a Bernoulli
    sample of ``df`` - at most ``1 / hot_share`` keys, so the result has a
    proven size bound and can be broadcast."""
    sample = df.select(key).where(F.col(key).isNotNull())
    if sample_fraction < 1.0:
        sample = sample.sample(withReplacement=False, fraction=sample_fraction, seed=seed)
    n = sample.count()
    threshold = max(2, math.ceil(hot_share * n))
    return (sample.groupBy(key).agg(F.count(F.lit(1)).alias("__tf_c"))
            .where(F.col("__tf_c") >= threshold).select(key))


def lookup_join(df: DataFrame, table: DataFrame, key: str, *, how: str = "left",
                max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                salt_buckets: int = 32, salt_by: list[str] | None = None,
                known_rows: int | None = None, sample_fraction: float = 0.01,
                hot_share: float = 0.001, allow_broadcast: bool = True) -> DataFrame:
    """Join a (possibly skewed) stream ``df`` to a lookup ``table`` that has
    one row per ``key``.

    * ``known_rows`` (a proven bound, e.g. a top-k vocabulary) or a counted
      size under ``max_broadcast_rows`` -> broadcast hash join, no shuffle
      of ``df``;
    * otherwise a shuffle join on ``(key, salt)`` that splits only the hot
      keys: keys holding at least ``hot_share`` of a sample of ``df`` (at
      most ``1 / hot_share`` of them, broadcast) get a deterministic salt
      in ``[0, salt_buckets)`` from a hash of ``salt_by`` (so a retried
      task reproduces it) and their table rows are copied
      ``salt_buckets`` times; every other key keeps salt 0 and a single
      table row. A key holding a third of all rows is cut into
      ``salt_buckets`` tasks, and the table grows only by the hot keys'
      copies.

    ``allow_broadcast=False`` skips the size check for tables that are
    large by nature (decoded images), where counting would mean reading
    them an extra time.
    """
    if how not in ("left", "inner", "left_anti", "left_semi"):
        raise ValueError(f"unsupported join type {how}")
    if allow_broadcast:
        small = known_rows is not None and known_rows <= max_broadcast_rows
        if small or table_rows_at_most(table, max_broadcast_rows):
            return df.join(F.broadcast(table), on=key, how=how)
    # written once: both sides must salt exactly the same keys
    hot = cut_lineage(hot_keys(df, key, sample_fraction=sample_fraction, hot_share=hot_share))
    hot = F.broadcast(hot.withColumn("__tf_hot", F.lit(True)))
    salt_cols = salt_by or list(df.columns)
    salt = "__tf_salt"
    stream = df.join(hot, on=key, how="left")
    stream = stream.withColumn(salt, F.when(F.col("__tf_hot").isNotNull(),
                                            F.pmod(F.xxhash64(*salt_cols), F.lit(salt_buckets)))
                               .otherwise(F.lit(0).cast("long"))).drop("__tf_hot")
    copies = table.join(hot, on=key, how="left").withColumn(
        salt, F.explode(F.when(F.col("__tf_hot").isNotNull(),
                               F.sequence(F.lit(0).cast("long"), F.lit(salt_buckets - 1).cast("long")))
                        .otherwise(F.array(F.lit(0).cast("long"))))).drop("__tf_hot")
    return stream.join(copies, on=[key, salt], how=how).drop(salt)
