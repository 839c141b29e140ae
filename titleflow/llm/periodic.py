"""Runs of periodically repeated words: block convolution at dyadic scales.

A run is a stretch of consecutive words with smallest period q (words q
apart are equal) and at least ``max(least, 2 q)`` words, which no
neighbouring word extends.

1. The texts of a task are cut into words, equal words of a group of texts
   get equal numbers, and the texts of the group are laid end to end with a
   number of its own between any two, which no stretch of two periods can
   cross.
2. Scale B = 1, 2, 4, ... looks for the periods 2B-1 to 4B-2. The first q
   words of a run with such a period hold a whole block of B words that
   starts at a multiple of B, and the block stands again q words later. So
   for each block the sum of squared differences against every place of the
   window that follows, x^2 + y^2 - 2xy, is taken by number theoretic
   transforms of 4B points (modulo a prime, in doubles that hold every
   integer on the way exactly). A sum of zero is an occurrence; its
   distance is a seed. Blocks whose rarest word does not stand again at any
   of these distances have no occurrence and are passed over.
3. Every seed (place, distance) is extended as far as the words agree to
   either side: binary search over prefix hashes, all seeds at once. Of the
   distances that give the same stretch the smallest is its period, and
   every stretch is compared word by word before it is returned; one that
   a hash took too far is extended word by word instead.

A sum that is zero only modulo the prime gives a seed that is extended like
any other, and dropped as too short.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import let, words

#: Prime 7 * 2^20 + 1 with primitive root 3: transforms of up to 2^20 points.
PRIME, ROOT = 7 * 2**20 + 1, 3
#: Longest block that is transformed; longer ones are found by their first words.
BLOCK = 1 << 16
#: Words that are analysed together (one text may have more), and numbers in a batch of transforms.
GROUP_WORDS, SLICE = 1 << 18, 1 << 19

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def _mod(a: np.ndarray) -> np.ndarray:
    """``a`` modulo the prime, between -1 and the prime; exact for |a| < 2^53."""
    q = a * (1.0 / PRIME)
    np.floor(q, out=q)
    q *= PRIME
    return np.subtract(a, q, out=q)


@lru_cache(maxsize=64)
def _powers(half: int, inverse: bool) -> np.ndarray:
    """The first ``half`` powers of a root of unity of order 2 * half."""
    w = pow(ROOT, (PRIME - 1) // (2 * half), PRIME)
    w = pow(w, PRIME - 2, PRIME) if inverse else w
    out = np.ones(1, np.int64)
    while len(out) < half:
        out = np.concatenate([out, out * pow(w, len(out), PRIME) % PRIME])
    return out.astype(np.float64)


def forward(a: np.ndarray) -> np.ndarray:
    """Transform of every row, in bit-reversed order (decimation in frequency)."""
    half = a.shape[1] // 2
    while half:
        v = a.reshape(len(a), -1, 2, half)
        total, rest = v[:, :, 0] + v[:, :, 1], v[:, :, 0] - v[:, :, 1]
        v[:, :, 0] = _mod(total)
        v[:, :, 1] = _mod(rest * _powers(half, False)) if half > 1 else _mod(rest)
        half //= 2
    return a


def backward(a: np.ndarray) -> np.ndarray:
    """Inverse of :func:`forward`, times the number of points."""
    half = 1
    while half < a.shape[1]:
        v = a.reshape(len(a), -1, 2, half)
        other = _mod(v[:, :, 1] * _powers(half, True)) if half > 1 else v[:, :, 1].copy()
        first = v[:, :, 0].copy()
        v[:, :, 0] = _mod(first + other)
        v[:, :, 1] = _mod(first - other)
        half *= 2
    return a


def occurrences(x: np.ndarray, squares: np.ndarray, at: np.ndarray, size: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of the zero-mismatch occurrences of the blocks of
    ``size`` words at ``at`` in distances ``first`` to ``first + 2 * size - 1``.

    ``x`` holds the words' numbers, padded; ``squares`` the sums of their
    squares modulo the prime up to each place.
    """
    points, lags = 4 * size, np.arange(2 * size)
    starts, hits = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for k in range(0, len(at), max(1, SLICE // points)):
        s = at[k:k + max(1, SLICE // points)]
        block, window = np.zeros((len(s), points)), np.zeros((len(s), points))
        block[:, :size] = x[s[:, None] + np.arange(size - 1, -1, -1)]
        window[:, :3 * size - 1] = x[s[:, None] + first + np.arange(3 * size - 1)]
        product = backward(_mod(forward(block) * forward(window)))[:, size - 1:3 * size - 1]
        there = s[:, None] + first + lags
        own = (squares[s + size] - squares[s])[:, None]
        rest = _mod(((own + squares[there + size] - squares[there]) % PRIME).astype(np.float64) * points - 2 * product)
        row, lag = np.nonzero((rest == 0) | (rest == PRIME))
        starts.append(s[row])
        hits.append(first + lag)
    return np.concatenate(starts), np.concatenate(hits)


def _seeds(ids: np.ndarray, ends: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) over all scales; ``ends``: of each place, where its text ends."""
    n = len(ids)
    count = np.bincount(ids)
    order = np.argsort(ids, kind="stable")
    places = ids[order].astype(np.int64) * (n + 1) + order
    reach = 6 * max(1, longest)
    x = np.concatenate([ids, np.zeros(reach, ids.dtype)]).astype(np.float64)
    squares = np.concatenate([[0], np.cumsum(np.concatenate([ids, np.zeros(reach, ids.dtype)]).astype(np.int64) ** 2 % PRIME)])
    starts, hits = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    scale = 1
    while 2 * (2 * scale - 1) <= longest:
        at = np.arange(0, n - scale + 1, scale)
        at = at[ends[at] - at >= 3 * scale - 1]
        if len(at):
            rare = at + count[ids[at[:, None] + np.arange(scale)]].argmin(1) if scale > 1 else at
            key = ids[rare].astype(np.int64) * (n + 1) + rare
            found = np.searchsorted(places, key + 2 * scale - 1)
            near = places[np.minimum(found, n - 1)]
            at = at[(found < n) & (near <= np.minimum(key + 4 * scale - 2, (ids[rare].astype(np.int64) + 1) * (n + 1) - 1))]
            size = min(scale, BLOCK)
            for first in range(2 * scale - 1, 4 * scale - 1, 2 * size):
                s, d = occurrences(x, squares, at, size, first)
                starts.append(s)
                hits.append(d)
        scale *= 2
    return np.concatenate(starts), np.concatenate(hits)


def _agreeing(ids: np.ndarray, longest: int):
    """lce(i, j): number of equal words from i and j on, by prefix hashes."""
    n = len(ids)
    v = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        v = (v ^ (v >> np.uint64(shift))) * np.uint64(factor)
    power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n, 0xD1342543DE82EF95, np.uint64)]))
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(v * power[:n])])

    def lce(i: np.ndarray, j: np.ndarray) -> np.ndarray:
        low, high = np.zeros(len(i), np.int64), np.minimum(longest, n - j)
        while (low < high).any():
            mid = (low + high + 1) // 2
            same = (prefix[i + mid] - prefix[i]) * power[j - i] == prefix[j + mid] - prefix[j]
            low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
        return low

    return lce


def _word_by_word(ids: np.ndarray, at: int, d: int) -> tuple[int, int]:
    """The stretch with period ``d`` around the words at ``at`` and ``at + d``; they differ: none."""
    if ids[at] != ids[at + d]:
        return at, at
    a, b = at, at + d
    while a > 0 and ids[a - 1] == ids[a - 1 + d]:
        a -= 1
    while b < len(ids) and ids[b] == ids[b - d]:
        b += 1
    return a, b


def find_runs(texts: list[np.ndarray], least: int = 12) -> list[np.ndarray]:
    """Of each text (its words' numbers) the runs (start, length, period) by
    start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    longest = int(sizes.max(initial=0))
    if longest < least:
        return [np.empty((0, 3), np.int64)] * len(texts)
    top = max((int(t.max()) for t in texts if len(t)), default=0)
    marks = top + 1 + np.arange(len(texts))
    ids = np.concatenate([y for t, m in zip(texts, marks, strict=True) for y in (t, [m])]).astype(np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    place, period = _seeds(ids, np.repeat(begins[1:] - 1, sizes + 1), longest)
    keep = place + period < len(ids)
    place, period = place[keep], period[keep]

    after = _agreeing(ids, longest)
    mirror, last = _agreeing(ids[::-1], longest), len(ids) - 1
    right = after(place, place + period)
    left = mirror(last - (place + period), last - place) if len(place) else right
    begin, end = place - left + 1, place + period + right  # the word at ``place`` counts on both sides
    some = (right > 0) & (end - begin >= np.maximum(least, 2 * period))
    rows = pd.DataFrame({"begin": begin[some], "end": end[some], "period": period[some], "at": place[some]})
    rows = rows.sort_values(["begin", "end", "period"]).drop_duplicates(["begin", "end"])
    found = []
    for a, b, q, at in rows.itertuples(index=False):
        if not (np.array_equal(ids[a:b - q], ids[a + q:b]) and (a == 0 or ids[a - 1] != ids[a - 1 + q])
                and (b == len(ids) or ids[b] != ids[b - q])):
            a, b = _word_by_word(ids, at, q)
        if b - a >= max(least, 2 * q):
            found.append((a, b - a, q))
    out = np.array(sorted(set(found)), np.int64).reshape(-1, 3)
    text = np.searchsorted(begins, out[:, 0], side="right") - 1
    out[:, 0] -= begins[text]
    cuts = np.searchsorted(text, np.arange(len(texts) + 1))
    return [out[cuts[i]:cuts[i + 1]] for i in range(len(texts))]


def collapse(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words stay: those that no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n]) == 0


def _groups(texts: list[bytes]) -> Iterator[list[list[bytes]]]:
    """Words of consecutive texts, some ``GROUP_WORDS`` words together."""
    group, size = [], 0
    for t in texts:
        cut = t.split()  # bytes are cut at \x20 and \x09-\x0D
        group.append(cut)
        size += len(cut) + 1
        if size >= GROUP_WORDS:
            yield group
            group, size = [], 0
    if group:
        yield group


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 12) -> DataFrame:
    """Per row of ``docs`` its id, ``runs`` (structs start, length, period by
    start, then period) and ``collapsed``: the words that no run holds after
    its first period, joined by one space.

    Null and empty texts have no words, no runs and an empty ``collapsed``;
    repeated rows and null ids give a row each; an empty table gives none;
    other columns play no part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for group in _groups([t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]):
                sizes = [len(w) for w in group]
                numbers = pa.array([w for t in group for w in t], pa.binary()).dictionary_encode().indices.to_numpy()
                cuts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
                runs = find_runs([numbers[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], least)
                kept = [w if not len(r) else [w[i] for i in np.flatnonzero(collapse(len(w), r))]
                        for w, r in zip(group, runs, strict=True)]
                all_runs = np.concatenate(runs) if runs else np.empty((0, 3), np.int64)
                offsets = np.concatenate([[0], np.cumsum([len(r) for r in runs])]).astype(np.int32)
                spans = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(
                    [pa.array(all_runs[:, i]) for i in range(3)], ["start", "length", "period"]))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(group)), spans,
                     pa.array([b" ".join(k) for k in kept], pa.binary()).cast(pa.string())], [id_col, "runs", "collapsed"])
                at += len(group)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(f"`{id_col}`"), F.col(f"`{text}`")).mapInArrow(
        run, f"`{id_col}` {kind}, runs {RUNS}, collapsed string")


def planted(doc_id: Column, text: Column) -> Column:
    """The query's input: of a tenth of the ids (by crc32), the text from a
    word on that the id names goes on with period p. Null ids and texts
    without words stay as they are."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def repeat(w: Column) -> Column:
        n = F.size(w).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        return F.array_join(F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda i: F.get(
            w, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int"))), " ")

    some = let(words(text), lambda w: F.when(F.size(w) > 0, repeat(w)).otherwise(F.lit("")))
    return F.when(h % 10 == 0, some).otherwise(text)


def run_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The query's columns of :func:`periodic_runs`."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("before"), (-r["period"]).alias("shorter"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))), "")
    return found.select(id_col, "runs", "collapsed", best.alias("best")).select(
        id_col, F.size("runs").cast("long").alias("n_runs"), (-F.col("best.before")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.shorter")).alias("period"),
        F.floor(1000 * F.col("best.length") / (-F.col("best.shorter"))).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
