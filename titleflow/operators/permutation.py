"""Epoch orders by a keyed permutation of row numbers.

:func:`titleflow.operators.sampling.epoch_batches` sorts the data once per
epoch. Here the rows are numbered once, and the place of a row in any
epoch's order is computed from its number: neither a sort nor a shuffle of
the data, and an order that nobody asks for costs nothing.

The numbers 0..n-1 are written as pairs (l, r) with l < a, r < b, where
a = ceil(sqrt n) and b = ceil(n / a). A round adds a keyed hash of r to l
modulo a and then one of l to r modulo b; both steps can be undone, so four
rounds permute the a * b pairs. There are less than a pairs too many: a
number that lands on one goes on until it lands below n (cycle walking),
which keeps the whole a permutation of 0..n-1.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Modulus and factors of the round hash (31 bits, so that squares stay below 2^62).
MODULUS, FACTOR, STEP = 2147483647, 48271, 16807
ROUNDS = 4
#: Walks beyond this many steps fail; up to n = WALKS^2 none can be longer, above the chance is below n^(1 - WALKS / 2).
WALKS = 16


def sides(n: int) -> tuple[int, int]:
    a = math.isqrt(max(n, 1) - 1) + 1
    return a, -(-max(n, 1) // a)


def round_hash(value: str, key: str, i: str) -> str:
    """SQL of the keyed hash of ``value`` in round ``i``; Spark and other engines read it alike."""
    mixed = f"((({value}) * {FACTOR} + ({key}) + ({i}) * {STEP}) % {MODULUS})"
    return f"(({mixed} * {mixed}) % {MODULUS})"


def epoch_key(seed: int, epoch: str) -> str:
    """SQL of an epoch's key."""
    return f"(({int(seed) % MODULUS} * 69621 + ({epoch}) * 40692 + 1) % {MODULUS})"


def _once(value: str, n: int, key: str) -> str:
    a, b = sides(n)
    left = f"(s.l + {round_hash('s.r', key, '2 * i')}) % {a}"
    return (f"aggregate(sequence(1, {ROUNDS}), named_struct('l', ({value}) div {b}, 'r', ({value}) % {b}), (s, i) -> "
            f"named_struct('l', {left}, 'r', (s.r + {round_hash(left, key, '2 * i + 1')}) % {b}), s -> s.l * {b} + s.r)")


def permuted(pos: str, n: int, seed: int, epoch: str) -> Column:
    """The place of row number ``pos`` (a long column) of ``n`` in the order
    of ``epoch`` (a column or number). NULL stays NULL."""
    if n >= 1 << 60:
        raise ValueError("at most 2^60 rows")
    key = epoch_key(seed, f"cast({epoch} as bigint)")
    walk = (f"aggregate(sequence(1, {WALKS}), {_once(f'`{pos}`', n, key)}, "
            f"(v, j) -> case when v < {n} then v else {_once('v', n, key)} end)")
    place = F.expr(walk)
    return F.when(F.col(f"`{pos}`").isNull(), F.lit(None).cast("long")).otherwise(
        F.when(place < n, place).otherwise(F.raise_error(F.lit("no place found for a row")).cast("long")))


def permuted_epochs(df: DataFrame, n: int, epochs: int, size: int, seed: int = 42, *, pos: str = "pos") -> DataFrame:
    """``df`` once per epoch with ``epoch``, ``epoch_pos`` (the row's place in
    that epoch's order) and ``batch_id``.

    ``pos`` are the row numbers 0..n-1, computed once by ``with_position`` or
    ``with_file_position``. A map over the rows: no exchange. Rows without
    a number keep a NULL place and batch; an empty table stays empty.
    """
    if epochs <= 0 or size <= 0:
        raise ValueError("epochs and batch size must be positive")
    each = df.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    each = each.withColumn("epoch_pos", permuted(pos, n, seed, "epoch"))
    return each.withColumn("batch_id", F.expr(f"epoch_pos div {int(size)}"))
