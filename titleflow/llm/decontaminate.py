"""Benchmark decontamination: SimHash over item-sized windows.

A document leaks an item if some window with as many words as the item has
a weighted similarity (multiset Jaccard over word shingles) of 0.8 or more
with it. Per Arrow batch of documents:

1. The text is folded to words (ASCII letters in lower case, other ASCII
   characters are gaps) and its shingles are hashed.
2. Of m shingles a window at similarity s shares 2 s m / (1 + s) at least
   with its item. Every item-sized window with that many places whose
   shingle stands in any item gets a SimHash, from running sums of the
   shingles' bits; the others can leak nothing.
3. A multi-index over the items' fingerprints (eight blocks of eight bits)
   looks windows up: fingerprints at most ``RADIUS`` bits apart differ in
   at most RADIUS // 8 bits of one block, and each block's table holds all
   values within that distance, so no fingerprint within the radius is
   missed. The Hamming distance then sifts the candidates. Where one
   shingle is repeated so often that a fifth of the weight may be a few
   shingles only, in the item or in the window, the bits move much further
   than that: such items and windows go to the exact check without a sieve.
4. The exact weighted similarity verifies what is left.

Documents are only streamed through: no shuffle. Items are broadcast in
blocks of at most ``block_chars`` characters; a larger benchmark takes
further passes over the documents, one per block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.llm.licenses import _FOLD

#: Largest Hamming distance of fingerprints: two windows at similarity 0.8
#: differ in about 10 of 64 bits, with a standard deviation of about 3, if
#: their shingles' squared counts sum up to at most ``EVEN`` times their number.
RADIUS, EVEN = 22, 1.5
_MAP_BITS = 20
#: Starts of windows that share one table of bit sums.
_REGION = 1 << 10


def fold_words(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


class Text:
    """Words of a text and the hashes of its k-word shingles."""

    def __init__(self, raw: bytes):
        words = fold_words(raw)
        self.n = len(words)
        self.line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, self.n) + 1) - 1
        self.ends = ends
        self.starts = np.concatenate(([0], ends[:-1] + 1)) if self.n else ends

    def shingles(self, k: int) -> np.ndarray:
        n = self.n - k + 1
        if n < 1:
            return np.empty(0, np.uint64)
        line, hashed = self.line, xxhash.xxh64_intdigest
        spans = zip(self.starts[:n].tolist(), self.ends[k - 1:].tolist(), strict=True)
        return np.fromiter((hashed(line[s:e]) for s, e in spans), np.uint64, n)


def _bits(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_sums(h: np.ndarray) -> np.ndarray:
    """Row i: how often each bit is set in the first i hashes."""
    return np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(_bits(h), axis=0, dtype=np.int32)])


def window_hashes(sums: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """SimHash of the ``m`` shingles from each of the starts."""
    over = 2 * (sums[starts + m] - sums[starts]) > m
    return np.packbits(over, axis=1, bitorder="little").view("<u8").ravel()


class MultiIndex:
    """Fingerprints by eight blocks of eight bits; complete within the radius."""

    def __init__(self, fps: np.ndarray, radius: int):
        self.fps, self.radius = fps, radius
        blocks = fps.astype("<u8").view(np.uint8).reshape(-1, 8)
        values = np.arange(256, dtype=np.uint8)
        near = np.bitwise_count(values[:, None] ^ values[None, :]) <= radius // 8
        #: [block, value] -> packed flags of the items whose block is near the value
        self.tables = np.stack([np.packbits(near[:, blocks[:, b]], axis=1) for b in range(8)])

    def within(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) places of all pairs within the radius."""
        found = []
        step = max(1, (1 << 22) // max(1, len(self.fps)))
        for at in range(0, len(windows), step):
            part = windows[at:at + step]
            own = part.astype("<u8").view(np.uint8).reshape(-1, 8)
            flags = self.tables[0][own[:, 0]]
            for b in range(1, 8):
                flags = flags | self.tables[b][own[:, b]]
            w, i = np.nonzero(np.unpackbits(flags, axis=1, count=len(self.fps)))
            close = np.bitwise_count(part[w] ^ self.fps[i]) <= self.radius
            found.append((w[close] + at, i[close]))
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def uneven(counts: Counter) -> bool:
    """Whether a few shingles carry so much weight that the bits hang on them."""
    return sum(n * n for n in counts.values()) > EVEN * sum(counts.values())


def weighted_similarity(a: Counter, b: Counter) -> float:
    """Multiset Jaccard: sum of the smaller counts over sum of the larger."""
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    total = sum(a.values()) + sum(b.values()) - common
    return common / total if total else 0.0


class Benchmark:
    """Items by their number of words, with shingles and a multi-index."""

    def __init__(self, items: list[tuple[object, bytes]], shingle: int, similarity: float):
        self.similarity = similarity
        grouped: dict[int, list[tuple[object, Text]]] = {}
        for item_id, raw in items:
            text = Text(raw)
            if text.n:  # an item without words leaks nowhere
                grouped.setdefault(text.n, []).append((item_id, text))
        self.groups, known = {}, {}
        for length, members in sorted(grouped.items()):
            k = min(shingle, length)
            hashes = [t.shingles(k) for _, t in members]
            fps = np.array([window_hashes(bit_sums(h), np.zeros(1, np.int64), len(h))[0] for h in hashes], np.uint64)
            known.setdefault(k, []).extend(hashes)
            counts = [Counter(h.tolist()) for h in hashes]
            self.groups.setdefault(k, []).append((length, [i for i, _ in members], MultiIndex(fps, RADIUS), counts,
                                                  {i for i, c in enumerate(counts) if uneven(c)}))
        self.known = {k: np.unique(np.concatenate(v)) for k, v in known.items()}
        self.map = {}
        for k, h in self.known.items():
            self.map[k] = np.zeros(1 << _MAP_BITS, bool)
            self.map[k][h & np.uint64((1 << _MAP_BITS) - 1)] = True

    def _regions(self, h: np.ndarray, hit: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray]]:
        """(first start, bit sums from there) of the stretches of at most
        ``_REGION`` starts in which windows can hold a hit, in order."""
        widest = self.groups[k][-1][0] - k + 1
        for part in np.split(hit, np.flatnonzero(np.diff(hit) > widest + _REGION) + 1):
            for first in range(max(0, int(part[0]) - widest + 1), int(part[-1]) + 1, _REGION):
                yield first, bit_sums(h[first:first + _REGION + widest])

    def find(self, raw: bytes, first_only: bool = False) -> list[tuple[object, float, int, int]]:
        """(item, similarity, first word, words) of the best window of each
        leaked item; of equally similar windows the first one."""
        best: dict[tuple[int, int], tuple[object, float, int, int]] = {}
        text = Text(raw)
        for k, groups in self.groups.items():
            h = text.shingles(k)
            hit = np.flatnonzero(self.map[k][h & np.uint64((1 << _MAP_BITS) - 1)])
            place = np.minimum(np.searchsorted(self.known[k], h[hit]), len(self.known[k]) - 1)
            hit = hit[self.known[k][place] == h[hit]]
            if not len(hit):
                continue
            before = np.zeros(len(h) + 1, np.int32)
            before[hit + 1] = 1
            before = np.cumsum(before)
            for first, sums in self._regions(h, hit, k):
                for length, ids, index, counts, heavy in groups:
                    m = length - k + 1
                    need = math.ceil(2 * self.similarity * m / (1 + self.similarity) - 1e-9)
                    n = min(_REGION, len(h) - m + 1 - first)
                    if n < 1:
                        continue
                    starts = np.flatnonzero(before[first + m:first + n + m] - before[first:first + n] >= max(1, need))
                    if not len(starts):
                        continue
                    near: dict[int, set[int]] = {}
                    window, item = index.within(window_hashes(sums, starts, m))
                    for x, i in zip(window.tolist(), item.tolist(), strict=True):
                        near.setdefault(x, set()).add(i)
                    for x, w in enumerate((starts + first).tolist()):
                        own = Counter(h[w:w + m].tolist())
                        for i in range(len(ids)) if uneven(own) else sorted(near.get(x, set()) | heavy):
                            s = weighted_similarity(own, counts[i])
                            if s >= self.similarity and s > best.get((length, i), (None, 0.0))[1]:
                                best[length, i] = (ids[i], s, w, length)
                                if first_only:
                                    return list(best.values())
        return list(best.values())


@lru_cache(maxsize=2)
def _index(items: tuple, shingle: int, similarity: float) -> Benchmark:
    """Built once per Python worker and block of items."""
    return Benchmark(list(items), shingle, similarity)


def _blocks(benchmark: DataFrame, id_col: str, text: str, block_chars: int) -> list[tuple]:
    """Items in blocks of about ``block_chars`` characters, each broadcast.
    A benchmark is a table of test items; its size is measured first."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(id_col).alias("i"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    size = items.agg(F.sum(F.octet_length("t") + 64)).first()[0] or 0  # items without text weigh something, too
    n = max(1, -(-size // block_chars))
    part = F.pmod(F.xxhash64("i", "t"), F.lit(n))
    for b in range(n):
        rows = (items.where(part == b) if n > 1 else items).collect()
        yield spark.sparkContext.broadcast(tuple((r.i, r.t.encode()) for r in rows))


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text",
               item_id: str = "item_id", item_text: str = "text", shingle: int = 5, similarity: float = 0.8,
               block_chars: int = 8 << 20) -> DataFrame:
    """One row per document row and leaked item: id, item id, similarity,
    first_word and n_words of the best window.

    Null and empty texts leak nothing, items without words match nothing,
    items shorter than a shingle match as a whole. Repeated rows and null
    ids give rows of their own; other columns are ignored.
    """
    kind, item_kind = (d.schema[c].dataType.simpleString() for d, c in ((docs, id_col), (benchmark, item_id)))
    schema = f"`{id_col}` {kind}, `{item_id}` {item_kind}, similarity double, first_word long, n_words long"
    arrow_kind = pa.int64() if item_kind == "bigint" else pa.int32() if item_kind == "int" else pa.string()
    out = None
    for items in _blocks(benchmark, item_id, item_text, block_chars):
        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = _index(items.value, shingle, similarity)
            for batch in batches:
                place, rows = [], []
                for at, raw in enumerate(batch.column(1).cast(pa.binary()).to_pylist()):
                    for row in index.find(raw or b""):
                        place.append(at)
                        rows.append(row)
                kinds = (arrow_kind, pa.float64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(place, pa.int64())),
                     *[pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)]],
                    [id_col, item_id, "similarity", "first_word", "n_words"])

        part = docs.select(id_col, text).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
               item_text: str = "text", shingle: int = 5, similarity: float = 0.8,
               block_chars: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` that leak no item, columns unchanged (same rules
    as :func:`find_leaks`); the texts are filtered where they are."""
    out = docs
    place = docs.columns.index(text)
    for items in _blocks(benchmark, item_id, item_text, block_chars):
        def run(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            index = _index(items.value, shingle, similarity)
            for batch in batches:
                texts = batch.column(place).cast(pa.binary()).to_pylist()
                yield batch.filter(pa.array([not index.find(t or b"", True) for t in texts], pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
