"""Approximate nearest neighbours by largest inner product: a hash-prefix forest.

Every tree gives each vector a string of ``bits`` signs of random
projections; a tree is the array of all its strings in sorted order, in
which the vectors that share a prefix with a query stand side by side.

1. Equal vectors are one node (of its rows only the smallest ids can ever be
   an answer). A vector x becomes (x / M, sqrt(1 - |x / M|^2)), M the largest
   length, a query (q / |q|, 0): the angle between these orders by the inner
   product, and the strings agree in a bit with chance p = 1 - angle / pi.
2. The sorted array of a tree is cut by its leading bits into blocks of some
   ``block`` nodes; a prefix that is far too frequent (vectors that are
   nearly the same) is dealt over several blocks by a hash of the node. A
   task holds one block at a time, its nodes first and then the queries that
   go there, so its memory doesn't grow with the table.
3. Descent. In every tree the query finds its longest-prefix match, and the
   ``near`` strings on either side of it are compared: their k-th best inner
   product is a lower bound of the true one.
4. Synchronous ascent. A vector with that inner product shares no prefix of x
   bits with the query in any of the trees with chance (1 - p^x)^trees. All
   trees go up together to the deepest x at which this is at most ``miss``,
   and everything below that prefix is compared. Queries with close
   neighbours stop deep in the trees; a query without any climbs to the
   root, where one tree holds everything.
5. The best nodes of all trees are compared once more, term by term in
   double precision.

Nothing is capped: a block answers with all nodes that reach the bound, up
to the number asked for.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titleflow.llm.common import discard, stored

#: Nodes beyond the k + 1 best that are compared again, against rounding in the block products.
SLACK = 11
#: Rows of a lookup that is broadcast after it was counted.
BROADCAST_ROWS = 10_000
#: Vectors hashed together, and numbers in a block of products.
HASH_ROWS, PRODUCTS = 1024, 1 << 20


def _usable(rows: DataFrame, id_col: str, vec: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part."""
    out = rows.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vec}`").alias("vec")).where("vec_id is not null")
    fine = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    out = out.where(fine & F.exists("vec", lambda x: x != 0))
    sizes = out.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return out.where(F.size("vec") == (sizes[0]["size"] if sizes else 0)).distinct()


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(rows, -1)


def _coded(nodes: DataFrame, largest: float, query: bool, trees: int, bits: int, seed: int) -> DataFrame:
    """(node, vec) with ``codes``: the string of every tree as an integer."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes = None
        weights = 2.0 ** np.arange(bits - 1, -1, -1)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), batch.num_rows)
            if planes is None:
                planes = np.random.default_rng(seed).standard_normal((x.shape[1] + 1, trees * bits))
            length = np.sqrt((x * x).sum(1))
            if query:
                x, rest = x / length[:, None], np.zeros(len(x))
            else:
                x, rest = x / largest, np.sqrt(np.maximum(0.0, 1.0 - (length / largest) ** 2))
            full = np.concatenate([x, rest[:, None]], 1)
            codes = np.concatenate([((full[i:i + HASH_ROWS] @ planes) > 0).reshape(-1, trees, bits) @ weights
                                    for i in range(0, len(full), HASH_ROWS)]).astype(np.int64)
            flat = pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * trees, pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), flat], ["node", "vec", "codes"])

    kind = nodes.schema["vec"].dataType.simpleString()
    return nodes.select("node", "vec").mapInArrow(run, f"node {nodes.schema['node'].dataType.simpleString()}, vec {kind}, "
                                                       "codes array<bigint>")


class Block:
    """A piece of a tree's sorted array with its vectors."""

    def __init__(self, codes: list[np.ndarray], nodes: list[np.ndarray], vectors: list[np.ndarray]):
        self.codes, self.nodes, self.vectors = (np.concatenate(x) for x in (codes, nodes, vectors))

    def ranges(self, codes: np.ndarray, levels: np.ndarray, bits: int, near: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each query the places that it compares: those that share ``level``
        leading bits; a level below 0: the ``near`` ones on either side."""
        descend = levels < 0
        low_bits = np.where(descend, 0, bits - levels)
        first = (codes >> low_bits) << low_bits
        low = np.searchsorted(self.codes, first)
        high = np.where(descend, np.searchsorted(self.codes, codes, side="right") + near,
                        np.searchsorted(self.codes, first + (np.int64(1) << low_bits)))
        low = np.where(descend, low - near, low)
        # a run of equal strings around the query is cut to the same number on either side of its middle
        wide = descend & (high - low > 4 * near)
        middle = (low + high) // 2
        low, high = np.where(wide, middle - 2 * near, low), np.where(wide, middle + 2 * near, high)
        return np.maximum(low, 0), np.minimum(high, len(self.codes))

    def best(self, codes: np.ndarray, levels: np.ndarray, bounds: np.ndarray, vectors: np.ndarray, bits: int, near: int,
             k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query, nodes, products): the k best of each query that reach its bound."""
        low, high = self.ranges(codes, levels, bits, near)
        order = np.lexsort((high, low))
        cuts = np.flatnonzero(np.diff(low[order], prepend=-1) | np.diff(high[order], prepend=-1)).tolist() + [len(order)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            x, y = int(low[order[a]]), int(high[order[a]])
            if x >= y:
                continue
            step = max(1, PRODUCTS // (y - x))
            for i in range(a, b, step):
                q = order[i:min(b, i + step)]
                products = vectors[q] @ self.vectors[x:y].T
                least = bounds[q]
                if y - x > k:
                    least = np.maximum(least, np.partition(products, y - x - k, axis=1)[:, y - x - k])
                row, col = np.nonzero(products >= least[:, None])
                at = np.searchsorted(row, np.arange(len(q) + 1))
                for j, query in enumerate(q):
                    places = col[at[j]:at[j + 1]]
                    if len(places):
                        nodes, values = self.nodes[x + places], products[j, places]
                        if len(places) > k:  # equal products: the smaller nodes
                            keep = np.lexsort((nodes, -values))[:k]
                            nodes, values = nodes[keep], values[keep]
                        yield int(query), nodes, values


def _answers(index: DataFrame, queries: DataFrame, bits: int, near: int, k: int) -> DataFrame:
    """(query, node, product): what the blocks (tree, prefix, part) answer to the
    queries that were sent to them; a pair may come from several trees."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, block = None, ([], [], []), None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            tree, prefix, part, asks, code, node, level, bound = (c.to_numpy(zero_copy_only=False) for c in batch.columns[:8])
            vectors = _matrix(batch.column(8), n)
            change = np.flatnonzero((np.diff(tree) != 0) | (np.diff(prefix) != 0) | (np.diff(part) != 0) | (np.diff(asks) != 0)) + 1
            out: tuple[list, list, list] = ([], [], [])
            for a, b in zip([0, *change], [*change, n], strict=True):
                key = (tree[a], prefix[a], part[a])
                if key != now:
                    now, parts, block = key, ([], [], []), None
                if not asks[a]:
                    for have, new in zip(parts, (code, node, vectors), strict=True):
                        have.append(new[a:b].copy())
                    continue
                if not parts[0]:
                    continue  # no vector has this prefix
                block = block or Block(*parts)
                for q, nodes, products in block.best(code[a:b], level[a:b], bound[a:b], vectors[a:b], bits, near, k):
                    out[0].append(np.full(len(nodes), node[a + q]))
                    out[1].append(nodes)
                    out[2].append(products)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], ["query", "node", "product"])

    key = ["tree", "prefix", "part"]
    both = index.select(*key, F.lit(False).alias("asks"), "code", "node", F.lit(0).cast("long").alias("level"),
                        F.lit(0.0).alias("bound"), "vec").unionByName(
        queries.select(*key, F.lit(True).alias("asks"), "code", "node", "level", "bound", "vec"))
    dealt = both.repartition(*key).sortWithinPartitions(*key, "asks", "code", "node")
    return dealt.mapInArrow(run, "query long, node long, product double")


def _top(pairs: DataFrame, k: int) -> DataFrame:
    """The k best nodes of every query, once each."""
    once = pairs.groupBy("query", "node").agg(F.max("product").alias("product"))
    order = Window.partitionBy("query").orderBy(F.desc("product"), "node")
    return once.withColumn("o", F.row_number().over(order)).where(F.col("o") <= k)


def nearest(rows: DataFrame, asks: Column, id_col: str = "vec_id", vec: str = "embedding", k: int = 20, trees: int = 32,
            bits: int = 48, block: int = 8192, near: int = 10, miss: float = 0.08, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found of every
    row for which ``asks`` (a condition on ``vec_id``) holds, but itself.

    Ties go to the smaller id; all candidates if there are fewer than k.
    Rows without an id take no part, nor do vectors that are null, empty,
    zero, hold a null or non-finite component, or have another number of
    components than most. Rows equal in id and vector count once; a row
    whose id stands on several vectors is searched for each and never finds
    its own id. An empty table gives no rows; other columns play no part.
    """
    usable = stored(_usable(rows, id_col, vec))
    small = Window.partitionBy("vec").orderBy("vec_id")
    nodes = usable.withColumn("o", F.row_number().over(small)).where(F.col("o") <= k + 1).groupBy("vec").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = stored(nodes.select(F.col("ids")[0].alias("node"), "vec", "ids"))
    largest, count = nodes.agg(F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast(
        "double")))), F.count(F.lit(1))).first()
    asking = stored(usable.where(asks).join(nodes.select("vec", "node"), "vec").select("vec_id", "node"))

    # the trees: their leading bits name the blocks
    lead = max(0, math.ceil(math.log2(max(1, count / block))))
    coded = stored(_coded(nodes, largest or 1.0, False, trees, bits, seed))
    wanted = nodes.join(asking.select("node").distinct(), "node", "left_semi")
    queries = stored(_coded(wanted, largest or 1.0, True, trees, bits, seed))
    tree = F.posexplode("codes").alias("tree", "code")
    prefix = F.shiftright("code", bits - lead).alias("prefix")
    placed = coded.select("node", "vec", tree).select("*", prefix)
    full = stored(placed.groupBy("tree", "prefix").count().where(F.col("count") > 2 * block).select(
        "tree", "prefix", F.ceil(F.col("count") / block).cast("int").alias("parts")))
    full_small = F.broadcast(full) if full.count() <= BROADCAST_ROWS else full
    parts = F.coalesce("parts", F.lit(1))
    index = placed.join(full_small, ["tree", "prefix"], "left").withColumn(
        "part", F.pmod(F.xxhash64("node"), parts).cast("int")).drop("parts")

    def sent(q: DataFrame) -> DataFrame:
        """Queries with a prefix, to every part of it."""
        return q.join(full_small, ["tree", "prefix"], "left").withColumn(
            "part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")

    descend = queries.select("node", "vec", tree).select(
        "*", prefix, F.lit(-1).cast("long").alias("level"), F.lit(float("-inf")).alias("bound"))
    first = stored(_top(_answers(index, sent(descend), bits, near, k + 1 + SLACK), k + 1 + SLACK))

    # the k-th best of other nodes so far; fewer than k: no bound
    kth = first.where("node <> query").groupBy("query").agg(F.sort_array(F.collect_list("product"), asc=False).alias("p"))
    kth = kth.select(F.col("query").alias("node"), F.get("p", F.lit(k - 1)).alias("kth"))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("kth") / (length * (largest or 1.0))))
    agree = 1 - F.acos(cosine) / math.pi
    deepest = F.floor(math.log(1 - miss ** (1 / trees)) / F.log(agree))
    level = F.when(F.col("kth").isNull() | (agree <= 0), 0).when(agree >= 1, bits).otherwise(F.least(F.lit(bits), deepest))
    ascend = queries.join(kth, "node", "left").select(
        "node", "vec", "codes", level.cast("long").alias("level"),
        F.coalesce(F.col("kth") - 1e-9 * length * (largest or 1.0), F.lit(float("-inf"))).alias("bound"))
    ascend = ascend.select("node", "vec", "level", "bound", tree).where("level > 0 or tree = 0")
    # a prefix shorter than the blocks' leads to all blocks that begin with it
    top = f"shiftright(code, {bits} - cast(level as int))"
    open_bits = f"greatest({lead} - cast(level as int), 0)"
    ascend = ascend.withColumn("prefix", F.expr(
        f"explode(case when level >= {lead} then array(shiftright(code, {bits - lead})) else "
        f"sequence(shiftleft({top}, {open_bits}), shiftleft({top} + 1, {open_bits}) - 1) end)"))
    second = _answers(index, sent(ascend), bits, near, k + 1 + SLACK)
    found = stored(_top(second.unionByName(first.select("query", "node", "product")), k + 1 + SLACK).select("query", "node"))

    # term by term, on the original vectors
    exact = found.join(nodes.select("node", "vec", "ids"), "node").join(
        nodes.select(F.col("node").alias("query"), F.col("vec").alias("q")), "query")
    score = F.aggregate(F.zip_with("q", "vec", lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda a, x: a + x)
    each = exact.select("query", "ids", score.alias("score")).select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = each.withColumn("o", F.row_number().over(order)).where(F.col("o") <= k + 1)
    best = stored(best.groupBy(F.col("query").alias("node")).agg(F.sort_array(F.collect_list(F.struct("o", "vec_id", "score"))).alias("best")))
    for t in (usable, coded, queries, first, found):
        discard(t)
    own = asking.join(best, "node", "left").select(F.col("vec_id").alias("query_id"), F.slice(F.filter(
        "best", lambda x: x["vec_id"] != F.col("vec_id")), 1, k).alias("best"))
    return own.select("query_id", F.posexplode("best").alias("place", "x")).select(
        "query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), F.col("x.score").alias("score"))
