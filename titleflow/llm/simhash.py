"""SimHash near-duplicates with a Gray-order hierarchical index.

1. Fingerprints: one pass over the texts, Arrow batches, one XXH64 per
   shingle, bit counts in numpy. The thin (id, fingerprint) rows are stored.
2. Distinct fingerprints are dealt out by blocks of their bits: with
   ``radius + 1`` blocks two fingerprints within the radius agree on one
   block at least, so every link meets in some (block, bits) bucket. A
   bucket above ``bucket_rows`` is dealt out once more by ``radius + 1``
   blocks of its remaining bits, by the same argument.
3. Inside a bucket the fingerprints stand in Gray-rank order. The
   hierarchical index over them groups neighbours; a node holds the masked
   bit pattern that its members share beyond what its ancestors factored
   out already. A search adds up the differing pattern bits from the root
   down and drops a whole group as soon as the sum exceeds the radius.
4. A bucket hands over the spanning stars of its local components (at most
   one row per member, never all pairs); :mod:`components` joins them.

Memory in a task is one bucket; nothing but counts reaches the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import row_key, stored
from titleflow.llm.components import components

_CHUNK = 1 << 15
_FAN = 8  # children of an index node


def fingerprint(raw: bytes, shingle: int = 4, seed: int = 42) -> int:
    """Unsigned SimHash of a text's UTF-8 bytes.

    A-Z in lower case, words between ASCII white space, shingles (repeats
    included) joined by one blank; a shorter text is one shingle, a text
    without words has fingerprint 0.
    """
    words = raw.lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    n = len(words) - k + 1
    counts = np.zeros(64, np.int64)
    hashed = xxhash.xxh64_intdigest
    for at in range(0, n, _CHUNK):
        to = min(n, at + _CHUNK)
        spans = zip(starts[at:to].tolist(), ends[at + k - 1:to + k - 1].tolist(), strict=True)
        h = np.fromiter((hashed(line[s:e], seed) for s, e in spans), np.uint64, to - at)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprints(rows: DataFrame, text: str = "text", shingle: int = 4, seed: int = 42) -> DataFrame:
    """``rows`` with the text column replaced by ``fp`` (signed 64 bits)."""
    keep = [c for c in rows.columns if c != text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary()).to_pylist()
            fps = np.fromiter((fingerprint(t or b"", shingle, seed) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(fps.view(np.int64))], [*keep, "fp"])

    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keep), "fp long"])
    return rows.select(*[F.col(f"`{c}`") for c in keep], F.col(text)).mapInArrow(run, schema)


def gray_rank(value: Column) -> Column:
    """Place of a 64-bit word in the Gray sequence (inverse Gray code)."""
    for shift in (1, 2, 4, 8, 16, 32):
        value = value.bitwiseXOR(F.shiftrightunsigned(value, shift))
    return value


def _cuts(bits: int, parts: int) -> list[tuple[int, int]]:
    """(offset, width) of ``parts`` nearly equal blocks of ``bits`` bits."""
    at = [bits * i // parts for i in range(parts + 1)]
    return [(at[i], at[i + 1] - at[i]) for i in range(parts)]


def _block_structs(word: Column, bits: int, parts: int) -> Column:
    """Array of (block number, its bits, the other bits rotated to the low end)."""
    out = []
    for n, (at, width) in enumerate(_cuts(bits, parts)):
        low = word.bitwiseAND(F.lit((1 << at) - 1).cast("long"))
        high = F.shiftrightunsigned(word, at)
        own = high.bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        above = F.shiftrightunsigned(high, width) if width < 64 else F.lit(0).cast("long")
        rest = F.shiftleft(above, at).bitwiseOR(low)
        out.append(F.struct(F.lit(n).alias("n"), own.alias("own"), rest.alias("rest"),
                            F.lit(bits - width).alias("bits")))
    return F.array(*out)


def buckets(fps: DataFrame, radius: int, bucket_rows: int) -> DataFrame:
    """(key, fp, gray): every two fingerprints within the radius share a key."""
    parts = radius + 1
    one = fps.select("fp", F.explode(_block_structs(F.col("fp"), 64, parts)).alias("b")).select(
        "fp", F.xxhash64("b.n", "b.own").alias("key"), "b.rest", "b.bits")
    hot = one.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > bucket_rows).select(
        "key", F.lit(True).alias("hot"))
    marked = one.join(hot, "key", "left")
    again = F.when(F.col("bits") == 64 - 64 // parts, _block_structs(F.col("rest"), 64 - 64 // parts, parts)
                   ).otherwise(_block_structs(F.col("rest"), 64 - 64 // parts - 1, parts))
    keys = F.when(F.col("hot"), F.transform(again, lambda x: F.xxhash64(F.lit(2), F.col("key"), x["n"], x["own"]))
                  ).otherwise(F.array("key"))
    return marked.select(F.explode(keys).alias("key"), "fp", gray_rank(F.col("fp")).alias("gray"))


class GrayIndex:
    """Hierarchical index over distinct 64-bit words in Gray-rank order.

    ``levels[0]`` is the root level. A node of a level covers ``_FAN``
    nodes of the next one; ``mask`` are the bits that all its members
    share and no ancestor factored out, ``pattern`` their values. The last
    level's nodes are the words themselves.
    """

    def __init__(self, words: np.ndarray):
        ones, zeros = words, ~words  # bits set in all members, bits clear in all members
        shared = [(ones, zeros)]
        while len(shared[0][0]) > _FAN:
            at = np.arange(0, len(shared[0][0]), _FAN)
            shared.insert(0, tuple(np.bitwise_and.reduceat(x, at) for x in shared[0]))
        self.levels = []
        above = None
        for one, zero in shared:
            mask = one | zero
            if above is not None:
                mask = mask & ~np.repeat(above, _FAN)[:len(mask)]
            self.levels.append((mask, one & mask))
            above = one | zero

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) places of all pairs at most ``radius`` bits apart."""
        width = len(self.levels[0][0])
        q = np.repeat(np.arange(len(queries)), width)
        node = np.tile(np.arange(width), len(queries))
        acc = np.zeros(len(q), np.uint8)
        for depth, (mask, pattern) in enumerate(self.levels):
            acc = acc + np.bitwise_count((queries[q] ^ pattern[node]) & mask[node])
            near = acc <= radius
            q, node, acc = q[near], node[near], acc[near]
            if depth + 1 < len(self.levels):
                size = len(self.levels[depth + 1][0])
                q, acc = np.repeat(q, _FAN), np.repeat(acc, _FAN)
                node = (node[:, None] * _FAN + np.arange(_FAN)).ravel()
                inside = node < size
                q, node, acc = q[inside], node[inside], acc[inside]
        return q, node


def local_roots(words: np.ndarray, radius: int) -> np.ndarray:
    """For each of distinct words in Gray order the place of its component's
    root, linking words at most ``radius`` bits apart. Searches run in
    blocks of queries, so the pairs held at once stay bounded."""
    n = len(words)
    label = np.arange(n)
    if n < 2:
        return label
    index = GrayIndex(words)
    step = max(1, (1 << 21) // n)
    for at in range(0, n, step):
        q, hit = index.within(words[at:at + step], radius)
        q = q + at
        ahead = hit > q
        a, b = label[q[ahead]], label[hit[ahead]]
        differ = a != b
        if differ.any():
            parent: dict[int, int] = {}

            def root(x: int) -> int:
                while (up := parent.get(x, x)) != x:
                    parent[x] = parent.get(up, up)
                    x = up
                return x

            for x, y in np.unique(np.stack([a[differ], b[differ]], 1), axis=0).tolist():
                x, y = root(x), root(y)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            moved = np.arange(n)
            moved[list(parent)] = [root(x) for x in parent]
            label = moved[label]
    return label


def _stars(radius: int):
    """Streams sorted (key, fp) rows; emits (a, b) star edges per bucket."""
    def edges(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        label = local_roots(words, radius)
        moved = label != np.arange(len(words))
        return words[moved], words[label[moved]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)

        def out(pairs: list) -> pa.RecordBatch:
            cols = [np.concatenate([p[i] for p in pairs]) if pairs else np.empty(0, np.uint64) for i in (0, 1)]
            return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in cols], ["a", "b"])

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy(zero_copy_only=False)])
            fps = np.concatenate([fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            cut = np.flatnonzero(keys[1:] != keys[:-1]) + 1
            bounds = [0, *cut.tolist()]
            yield out([edges(fps[s:e]) for s, e in zip(bounds, bounds[1:], strict=False) if e - s > 1])
            keys, fps = keys[bounds[-1]:], fps[bounds[-1]:]
        if len(fps) > 1:
            yield out([edges(fps)])

    return run


def links(fps: DataFrame, radius: int = 4, bucket_rows: int = 20_000) -> DataFrame:
    """Edges (a, b) that connect exactly the distinct fingerprints of ``fps``
    that chains of links (at most ``radius`` differing bits) connect."""
    dealt = buckets(fps, radius, bucket_rows)
    parts = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    run = dealt.repartition(parts, "key").sortWithinPartitions("key", "gray").select("key", "fp")
    return run.mapInArrow(_stars(radius), "a long, b long").distinct()


def near_duplicates(rows: DataFrame, id_col: str = "doc_id", radius: int = 4,
                    bucket_rows: int = 20_000) -> DataFrame:
    """``rows`` (id, fp) with ``root`` (a fingerprint of the component) and
    ``component_id`` (its smallest id, null if all its ids are null)."""
    classes = stored(rows.groupBy("fp").agg(F.min(id_col).alias("least")))
    roots = components(links(classes.select("fp"), radius, bucket_rows))
    lab = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = lab.groupBy("root").agg(F.min("least").alias("component_id"))
    return rows.join(lab.select("fp", "root").join(ids, "root"), "fp")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4,
                       radius: int = 4, bucket_rows: int = 20_000) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    Null and empty texts have fingerprint 0 and link like any other;
    repeated rows give a row each; null ids never name a component; other
    columns are ignored.
    """
    thin = stored(fingerprints(docs.select(id_col, text), text, shingle))
    found = near_duplicates(thin, id_col, radius, bucket_rows)
    return found.select(id_col, F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text", shingle: int = 4,
             radius: int = 4, bucket_rows: int = 20_000) -> DataFrame:
    """One row of ``docs`` per near-duplicate group, columns unchanged: the
    one with the smallest id (nulls last), of equal ids the one with the
    smallest row hash; of wholly equal rows one."""
    key = row_key(docs)
    thin = stored(fingerprints(docs.select(id_col, *key, F.col(text).alias("__text")), "__text", shingle))
    found = near_duplicates(thin, id_col, radius, bucket_rows)
    first = found.groupBy("root").agg(F.min(F.struct(F.isnull(id_col).alias("n"), F.col(id_col).alias("i"),
                                                     F.col("__h1"), F.col("__h2"))).alias("k"))
    kept = first.select(F.col("k.__h1").alias("__h1"), F.col("k.__h2").alias("__h2"))
    return (docs.select("*", *key).join(kept, ["__h1", "__h2"], "left_semi")
            .dropDuplicates(["__h1", "__h2"]).select(*[F.col(f"`{c}`") for c in docs.columns]))
