"""Ordering, splitting, shuffling and batching.

The central piece is :func:`with_position`, a distributed row number
0..n-1 over a total order. ``Window.orderBy`` without ``partitionBy`` would
move every row into one task, so the order is cut into order-preserving
buckets instead:

1. every row gets a bucket that is monotone in the order key: the leading
   hex digits of an md5 key (uniform for unique keys), or, for a natural
   key, the interval between quantiles of a bounded key sample (at most
   ``MAX_BOUND_SAMPLE`` keys, cut by ``ntile`` inside Spark; only the
   bucket bounds reach the driver);
2. ``groupBy(bucket).count()`` gives a table with at most ``buckets`` rows
   per group; a running sum over that small table gives each bucket's
   offset;
3. the offsets go back by a broadcast join (size bounded by the bucket
   count) and ``row_number()`` over ``partitionBy(bucket)`` plus the offset
   is the global position.

One shuffle of the data (the window exchange) plus one tiny aggregate;
:func:`take_positions` shuffles only the rows of the buckets it needs, and
:func:`split_exact` none but rows with equal keys at the cut. A hot group (a third of all rows under one ``partition_by`` value) is spread
over all of its buckets, so no task receives the whole group. Positions are
deterministic: md5 and the bounds are fixed, and keys are unique inside a
group, so a retried task computes the same numbers.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType

_BUCKET = "__tf_bucket"
_ORDER = "__tf_order"


def _cols(x) -> list[str]:
    if x is None:
        return []
    if isinstance(x, str):
        return [x]
    return list(x)


def shuffle_key(key: Column | str, seed, *salts: Column | str) -> Column:
    """Deterministic pseudo-random order key: ``md5('<key>#<seed>[#salt..]')``.

    DuckDB writes the same value as ``md5(cast(key as varchar) || '#' ||
    seed ...)``, which is how the oracle reproduces the order.
    """
    k = F.col(key) if isinstance(key, str) else key
    # NULL keys share one place in the order instead of having none
    parts = [F.coalesce(k.cast("string"), F.lit("<null>")), F.lit(f"#{seed}")]
    for s in salts:
        salt = (F.col(s) if isinstance(s, str) else s).cast("string")
        parts += [F.lit("#"), F.coalesce(salt, F.lit("<null>"))]
    return F.md5(F.concat(*parts))


def default_buckets(df: DataFrame) -> int:
    """Bucket count for the position index: at least 4096 and four per
    shuffle partition, so a bucket stays a fraction of a task's input as
    the cluster (and ``spark.sql.shuffle.partitions``) grows."""
    try:
        parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    except ValueError:
        parts = 200
    return max(4096, 4 * parts)


def _md5_bucket(order_col: Column, buckets: int) -> Column:
    """Exactly ``buckets`` buckets, monotone in the md5 text: its first 32
    bits as a fraction of 2^32."""
    lead = F.conv(F.substring(order_col, 1, 8), 16, 10).cast("long")
    return F.shiftright(lead * F.lit(int(buckets)).cast("long"), 32).cast("int")


def _row_hash(df: DataFrame) -> Column:
    """Tie-break for rows with equal (or NULL) keys: makes their order, and
    so a retried task's numbers, repeatable."""
    return F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()])


# At most this many sampled keys reach the driver to place bucket bounds
# (the same budget Spark's range partitioner uses for its sample).
MAX_BOUND_SAMPLE = 1_000_000
SAMPLES_PER_BUCKET = 20
NULL_BUCKETS = 64


def _quantile_bucket(df: DataFrame, order_col: str, buckets: int) -> DataFrame:
    """Bucket a numeric order key by sampled quantiles.

    A row count (one cheap job) sizes both the bucket count (enough buckets
    for every core, about one per 100k rows, never more than ``buckets``)
    and a Bernoulli sample of about ``SAMPLES_PER_BUCKET`` keys per bucket,
    capped at ``MAX_BOUND_SAMPLE`` rows. The sample is cut into equal
    parts by ``ntile`` inside Spark (one task over at most that many rows)
    and only the ``buckets - 1`` bounds reach the driver. The bucket is
    monotone in the key (the double cast is monotone), so ranges stay
    ordered even when two large ids round to the same double; sampling
    error only makes buckets unequal in size. NULL keys come first, in
    buckets of their own below zero (several, by the row's hash, as they
    may be many); NaN comes last.
    """
    kind = df.schema[order_col].dataType
    if not isinstance(kind, (NumericType, BooleanType)):
        raise TypeError(f"a natural order needs a numeric column, not {kind.simpleString()}")
    return _value_bucket(df, order_col, buckets).withColumn(
        _BUCKET, F.when(F.col(order_col).isNull(), (F.pmod(_row_hash(df), F.lit(NULL_BUCKETS)) - NULL_BUCKETS).cast("int"))
        .otherwise(F.col(_BUCKET)))


def _value_bucket(df: DataFrame, order_col: str, buckets: int) -> DataFrame:
    n = df.count()
    cores = df.sparkSession.sparkContext.defaultParallelism
    buckets = max(1, min(buckets, max(2 * cores, n // 100_000), n // SAMPLES_PER_BUCKET or 1))
    if buckets == 1:
        return df.withColumn(_BUCKET, F.lit(0))
    target = min(MAX_BOUND_SAMPLE, SAMPLES_PER_BUCKET * buckets)
    frac = min(1.0, target / max(n, 1))
    keys = df.select(F.col(order_col).cast("double").alias("k")).where(F.col("k").isNotNull())
    if frac < 1.0:
        keys = keys.sample(withReplacement=False, fraction=frac, seed=17)
    tiles = keys.select("k", F.ntile(buckets).over(Window.orderBy("k")).alias("t"))
    tops = tiles.groupBy("t").agg(F.max("k").alias("b")).collect()
    bounds = sorted({r.b for r in tops if r.t < buckets})
    if not bounds:
        return df.withColumn(_BUCKET, F.lit(0))
    splits = [-math.inf] + bounds + [math.inf]
    tmp = "__tf_key_double"
    out = Bucketizer(splits=splits, inputCol=tmp, outputCol=_BUCKET,
                     handleInvalid="keep").transform(
        df.withColumn(tmp, F.col(order_col).cast("double")))
    return out.withColumn(_BUCKET, F.col(_BUCKET).cast("int")).drop(tmp)


def _bucketed(df: DataFrame, order_by: Column | str, parts: list[str], seed, salts,
              buckets: int | None, total: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The input with order key and bucket columns, and the small table of
    bucket offsets ``(parts, bucket, __tf_off, __tf_n[, total])``."""
    buckets = buckets or default_buckets(df)
    if seed is not None:
        keyed = df.withColumn(_ORDER, shuffle_key(order_by, seed, *salts))
        keyed = keyed.withColumn(_BUCKET, _md5_bucket(F.col(_ORDER), buckets))
    else:
        keyed = df.withColumn(_ORDER, F.col(order_by) if isinstance(order_by, str) else order_by)
        keyed = _quantile_bucket(keyed, _ORDER, buckets)
    counts = keyed.groupBy(*parts, _BUCKET).agg(F.count(F.lit(1)).alias("__tf_n"))
    w = Window.partitionBy(*parts).orderBy(_BUCKET).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select(
        *parts, _BUCKET, "__tf_n",
        (F.sum("__tf_n").over(w) - F.col("__tf_n")).alias("__tf_off"),
        *([F.sum("__tf_n").over(Window.partitionBy(*parts)).alias(total)] if total else []))
    return keyed, offsets


def _rank(rows: DataFrame, parts: list[str], out: str) -> DataFrame:
    """Position = bucket offset + row number inside the bucket; rows with
    equal keys are ordered by their hash."""
    rn = F.row_number().over(Window.partitionBy(*parts, _BUCKET).orderBy(F.col(_ORDER), _row_hash(rows)))
    return rows.withColumn(out, (rn - 1 + F.col("__tf_off")).cast("long"))


def with_position(df: DataFrame, order_by: Column | str, *,
                  partition_by: str | Sequence[str] | None = None,
                  seed=None, salts: Sequence[str] = (), out: str = "pos",
                  total: str | None = None, buckets: int | None = None,
                  materialize: bool = False) -> DataFrame:
    """Add ``out`` = 0-based position of each row in the order of
    ``order_by`` (ascending) inside each ``partition_by`` group.

    The index reads its input several times (bucket counts, and for a
    natural order a row count and a key sample, then the numbering pass).
    For an input that is expensive to recompute - model scores, say - pass
    ``materialize=True`` to write it once to the checkpoint folder first.

    With ``seed`` the order is the pseudo-random md5 order of
    :func:`shuffle_key` (``order_by`` is then the unique row key, and
    ``salts`` are extra columns mixed into the key, e.g. the epoch).
    Without ``seed`` the order is the natural order of the numeric
    ``order_by`` column. Keys must be unique inside a group. ``total``, if
    given, names a column with the group's row count.
    """
    parts = _cols(partition_by)
    if materialize:
        from titleflow.session import cut_lineage
        df = cut_lineage(df)
    keyed, offsets = _bucketed(df, order_by, parts, seed, salts, buckets, total)
    # Without a group column the offsets table has at most `buckets` rows,
    # a proven bound, so it is broadcast; with groups its size grows with
    # the number of groups and the join strategy is left to AQE, which
    # broadcasts it at run time only under the configured threshold.
    if not parts:
        offsets = F.broadcast(offsets)
    # rows of a NULL group are a group, too: the join must not lose them
    side = offsets.drop("__tf_n").withColumnsRenamed({c: f"__tf_g_{c}" for c in [*parts, _BUCKET]})
    same = reduce(and_, [keyed[c].eqNullSafe(side[f"__tf_g_{c}"]) for c in [*parts, _BUCKET]])
    joined = keyed.join(side, same, "inner").drop(*[f"__tf_g_{c}" for c in [*parts, _BUCKET]])
    return _rank(joined, parts, out).drop(_BUCKET, _ORDER, "__tf_off")


def take_positions(df: DataFrame, positions: Sequence[int] | DataFrame,
                   order_by: Column | str, *, seed=None, out: str = "pos",
                   buckets: int | None = None) -> DataFrame:
    """Rows at the given 0-based positions (the ``__getitem__`` of a
    dataset). ``positions`` is a list or a one-column DataFrame.

    With a list, only the buckets that hold a wanted position are ranked:
    the other rows are dropped by a broadcast join against the (small)
    table of wanted buckets before any shuffle, so fetching a batch does
    not sort the whole table.
    """
    if isinstance(positions, DataFrame):
        indexed = with_position(df, order_by, seed=seed, out=out, buckets=buckets)
        return indexed.join(positions.select(F.col(positions.columns[0]).cast("long").alias(out)),
                            on=out, how="left_semi")
    wanted = sorted({int(p) for p in positions})
    keyed, offsets = _bucketed(df, order_by, [], seed, (), buckets)
    arr = F.array(*[F.lit(p).cast("long") for p in wanted]) if wanted else F.array().cast("array<bigint>")
    hit = F.exists(arr, lambda p: (p >= F.col("__tf_off")) & (p < F.col("__tf_off") + F.col("__tf_n")))
    flagged = F.broadcast(offsets.where(hit).drop("__tf_n"))
    rows = keyed.join(flagged, on=_BUCKET, how="inner")
    ranked = _rank(rows, [], out)
    return ranked.where(F.col(out).isin(wanted)).drop(_BUCKET, _ORDER, "__tf_off")


def with_batch(df: DataFrame, size: int, *, pos: str = "pos",
               out: str = "batch_id") -> DataFrame:
    """Fixed-size batches over a position column; the last one may be short."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    # integer division: a double holds positions up to 2^53 only
    return df.withColumn(out, F.expr(f"`{pos}` div {int(size)}"))


def pool(**named: DataFrame) -> DataFrame:
    """UNION ALL of several tables with the same columns, tagged with a
    ``source`` column holding the keyword name."""
    if not named:
        raise ValueError("nothing to pool")
    out = None
    for name, d in named.items():
        tagged = d.withColumn("source", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def split_exact(df: DataFrame, key: str, fraction: float = 0.9, seed=42, *,
                out: str = "split", train: str = "train",
                validation: str = "validation",
                buckets: int | None = None) -> DataFrame:
    """Random split with exact sizes: the first ``floor(fraction * n)`` rows
    of the md5 order are ``train``, the rest ``validation``.

    Same rows for any partitioning of the input and for every rerun.
    ``floor`` is taken in double arithmetic (``int(0.9 * n)``).

    Two jobs over the key column find the order value at the cut (bucket
    counts, then the values of the one bucket that holds it); one row
    reaches the driver. The split itself compares every row with that
    value: one pass without a join or a shuffle. Only where rows with equal
    keys lie on both sides of the cut are those rows ranked by their hash.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be within [0, 1]")
    keyed, offsets = _bucketed(df, key, [], seed, (), buckets, total="__tf_total")
    cut = F.floor(F.lit(float(fraction)) * F.col("__tf_total").cast("double"))
    at = offsets.where((F.col("__tf_off") < cut) & (cut <= F.col("__tf_off") + F.col("__tf_n"))).select(
        _BUCKET, "__tf_off", cut.alias("__tf_cut")).first()
    if at is None:  # no rows, or all of them behind the cut
        return df.withColumn(out, F.lit(validation))
    inside = keyed.where(F.col(_BUCKET) == at[_BUCKET]).groupBy(_ORDER).agg(F.count(F.lit(1)).alias("__tf_n"))
    upto = F.lit(at["__tf_off"]) + F.sum("__tf_n").over(
        Window.orderBy(_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = inside.withColumn("__tf_upto", upto).where(F.col("__tf_upto") >= at["__tf_cut"]).orderBy("__tf_upto").first()
    value, order = last[_ORDER], F.col(_ORDER)
    # NULL order values (natural orders only) come first, in several buckets
    before = F.lit(False) if value is None else F.coalesce(order < F.lit(value), F.lit(True))
    tied = order.isNull() if value is None else order.eqNullSafe(F.lit(value))
    side = F.when(before | tied, F.lit(train)).otherwise(F.lit(validation))
    if value is not None and last["__tf_upto"] == at["__tf_cut"]:
        return keyed.withColumn(out, side).drop(_BUCKET, _ORDER)
    first = 0 if value is None else last["__tf_upto"] - last["__tf_n"]
    ties = keyed.where(tied).drop(_BUCKET, _ORDER)
    ties = with_position(ties, _row_hash(ties), out="__tf_pos", buckets=buckets)
    ties = ties.withColumn(out, F.when(F.col("__tf_pos") < at["__tf_cut"] - first, F.lit(train))
                           .otherwise(F.lit(validation))).drop("__tf_pos")
    return keyed.where(~tied).withColumn(out, side).drop(_BUCKET, _ORDER).unionByName(ties)


def split_hash(df: DataFrame, key: str, fraction: float = 0.9, seed=42, *,
               out: str = "split", train: str = "train",
               validation: str = "validation") -> DataFrame:
    """Cheap split without a shuffle: a row is ``train`` when the first 8 hex
    digits of its md5 key, read as a fraction of 16^8, are below
    ``fraction``. Sizes are only approximately ``fraction``."""
    u = F.conv(F.substring(shuffle_key(key, seed), 1, 8), 16, 10).cast("double") / float(16 ** 8)
    return df.withColumn(out, F.when(u < F.lit(float(fraction)), F.lit(train))
                         .otherwise(F.lit(validation)))


def split_by_source(df: DataFrame, train: str = "train",
                    validation: str = "validation", *, source: str = "source"
                    ) -> tuple[DataFrame, DataFrame]:
    """The fixed split: rows of the named training source and of the named
    validation source."""
    return (df.where(F.col(source) == F.lit(train)),
            df.where(F.col(source) == F.lit(validation)))


def epoch_batches(df: DataFrame, key: str, epochs: int, size: int, seed=42, *,
                  buckets: int | None = None) -> DataFrame:
    """The data once per epoch, reshuffled each epoch and cut into batches.

    Adds ``epoch`` (0-based), ``pos`` (position in that epoch's order) and
    ``batch_id``. The copies come from ``explode(sequence(0, epochs-1))``
    (no join); the order key mixes the epoch into the md5 key.
    """
    if epochs <= 0:
        raise ValueError("epochs must be positive")
    rep = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    pos = with_position(rep, key, partition_by="epoch", seed=seed, salts=["epoch"],
                        buckets=buckets)
    return with_batch(pos, size)


def step_count(df: DataFrame, size: int, epochs: int) -> DataFrame:
    """Optimiser steps of a run: ``ceil(n / size) * epochs`` (one row)."""
    n = F.count(F.lit(1))
    return df.agg(
        n.alias("n_rows"),
        F.lit(size).alias("batch_size"),
        F.lit(epochs).alias("epochs"),
        F.expr(f"(count(1) + {int(size) - 1}) div {int(size)} * {int(epochs)}").alias("steps"),
    )


def sample_param_maps(maps: Sequence, k: int, seed) -> list:
    """Seeded choice of ``k`` distinct parameter maps (driver-side; the grid
    is a handful of settings, not data)."""
    maps = list(maps)
    if k >= len(maps):
        return maps
    return random.Random(seed).sample(maps, k)
