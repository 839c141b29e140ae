"""Phrase collocation mining on a weighted de Bruijn graph.

Nodes are word sequences, edges the longest grams (``longest`` words), from
a gram's first words to its last ones, weighted by their number. Only the
edges are counted in the texts; all shorter counts follow from them:

1. Sieve. Every word and every pair of neighbouring words of a piece counts
   for one of ``2^SLOT_BITS`` slots of its language, chosen by a hash; in a
   second pass every three words whose pairs passed, and every word that is
   part of such a pair, without which its own count isn't needed. A phrase
   that occurs ``least`` times has no word, pair or triple of a slot that
   stays below; so a piece may be cut there without losing an occurrence. The slots that
   reach ``least`` form two bitmaps of 8 MB, however large the corpus; words
   that share a slot only let more through.
2. Edges. From every word of what is left of a piece goes one gram: the next
   ``longest`` words, or fewer up to the next cut. Equal grams are counted
   as texts, not as hashes.
3. Flow. A sequence of k words occurs as often as the sequences of k+1 words
   that begin with it (the flow out of its node) and the grams that end
   with it (corrections where a piece ends or is cut) together. Level by level this gives all
   counts down to words.
4. Unary paths. A phrase is dropped if it lies in a longer candidate that
   occurs as often. Counts can only fall as a phrase grows, so then the step
   to the next larger candidate has the same weight too: the node's only way
   on. Every candidate is thus compared with the two that are one word
   longer, and chains of them need no search.

Counts are 64-bit integers, products decimals of 38 digits.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titleflow.llm.common import stored

#: Slots of the sieve; its bitmap has a fixed size of 2^SLOT_BITS / 8 bytes.
SLOT_BITS = 26
#: Slots that are summed together.
BUCKET = 1 << 15
#: Bytes of text that are cut into words together (a longer piece stays whole); slots and grams merged in a task.
BLOCK_BYTES, MERGE_SLOTS, MERGE_GRAMS = 1 << 20, 1 << 21, 1 << 19
#: Parts of the edges that are merged together.
EDGE_BUCKETS = 1024
#: Languages up to this number are broadcast with their word counts.
FEW_LANGS = 10_000

#: Contract's characters: blanks between words, separators of pieces.
BLANKS, SEPARATORS = b" \t", b".,;:!?\x0a\x0b\x0c\x0d"

_LOW = np.arange(256, dtype=np.uint8)
_LOW[65:91] += 32
_LOW[list(BLANKS)] = 32
_LOW[list(SEPARATORS)] = 10
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD1342543DE82EF95], np.uint64)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _FACTORS[1]
    h = (h ^ (h >> np.uint64(27))) * _FACTORS[2]
    return h ^ (h >> np.uint64(32))


class Words:
    """The words of a block of texts: ``start`` and ``end`` in ``text`` (lower
    case, one blank between the words of a piece), the language of each, and
    whether the next word stands in the same piece."""

    def __init__(self, texts: list[bytes], langs: list[str]):
        raw = _LOW[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        gap = raw <= 32
        gap &= (raw == 32) | (raw == 10)
        # a blank before another one, before a separator or after one is not between words
        blank = raw == 32
        drop = np.zeros(len(raw), bool)
        drop[:-1] = blank[:-1] & gap[1:]
        kept = np.flatnonzero(~drop)
        self.text, inside = raw[kept], ~gap[kept]
        before = np.concatenate([[False], inside[:-1]])
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(~inside & before)
        after = np.minimum(self.end + 1, len(self.text) - 1)
        self.joined = (self.text[self.end] == 32) & inside[after]
        names = sorted(set(langs))
        self.names = names
        code = {n: i for i, n in enumerate(names)}
        ends = np.cumsum([len(t) + 1 for t in texts])
        doc = np.searchsorted(ends, kept[self.start], side="right")
        self.lang = np.array([code[x] for x in langs], np.int32)[doc]

    def slots(self) -> list[np.ndarray]:
        """The slots of every word, of every word with the next one, with the
        next two, and of every word as a part of pairs."""
        power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(self.text), _FACTORS[3])]))
        total = np.concatenate([[np.uint64(0)], np.cumsum((self.text.astype(np.uint64) + np.uint64(1)) * power[:-1])])
        # divided by the power of the place: the same word has the same number everywhere
        back = np.cumprod(np.concatenate([[np.uint64(1)], np.full(len(self.text), np.uint64(pow(int(_FACTORS[3]), -1, 1 << 64)))]))
        self.hashed = total, back
        word = _mix((total[self.end] - total[self.start]) * back[self.start])
        salt = np.array([zlib.crc32(n.encode()) for n in self.names] or [0], np.uint64)[self.lang] * _FACTORS[0]
        out, so_far = [_mix(word + salt)], word
        for k in (1, 2):
            so_far = so_far * _FACTORS[2]
            so_far[:-k] += word[k:] * _FACTORS[1]
            out.append(_mix(so_far ^ salt))
        out.append(_mix(word * _FACTORS[2] - salt))
        return [(h >> np.uint64(64 - SLOT_BITS)).astype(np.int64) for h in out]

    def links(self, slots: list[np.ndarray], bitmaps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which words pass, which go on to the next one, and which to the next two."""
        good = _bit(bitmaps[0], slots[0])
        if len(bitmaps) > 1:
            good &= _bit(bitmaps[1], slots[3])
        pair = self.joined & good & _bit(bitmaps[0], slots[1])
        pair[:-1] &= good[1:]
        triple = pair.copy()
        triple[:-1] &= pair[1:]
        triple[-1:] = False
        if len(bitmaps) > 1:
            triple &= _bit(bitmaps[1], slots[2])
        return good, pair, triple

    def buckets(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """A number below ``EDGE_BUCKETS`` that depends on the gram's text only (after :meth:`slots`)."""
        total, back = self.hashed
        begin = self.start[first]
        return (_mix((total[self.end[last]] - total[begin]) * back[begin]) % np.uint64(EDGE_BUCKETS)).astype(np.int32)

    def grams(self, first: np.ndarray, last: np.ndarray) -> pa.Array:
        """The texts from word ``first`` to word ``last``."""
        begin, size = self.start[first], self.end[last] - self.start[first]
        offsets = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(begin - offsets[:-1], size) + np.arange(offsets[-1])
        return pa.Array.from_buffers(pa.string(), len(first), [
            None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.text[at])])


def _cut(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end where a piece ends."""
    if len(text) <= BLOCK_BYTES:
        yield text
        return
    ends = np.flatnonzero(_LOW[np.frombuffer(text, np.uint8)] == 10)
    at = 0
    while at < len(text):
        k = max(np.searchsorted(ends, at + BLOCK_BYTES) - 1, np.searchsorted(ends, at))
        stop = int(ends[k]) + 1 if k < len(ends) else len(text)
        yield text[at:stop]
        at = stop


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    """Words of (lang, text) rows, about ``BLOCK_BYTES`` of text together."""
    texts, langs, size = [], [], 0
    for batch in batches:
        rows = zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist(), strict=True)
        for lang, text in rows:
            for part in _cut(text):
                texts.append(part)
                langs.append(lang)
                size += len(part)
                if size >= BLOCK_BYTES:
                    yield Words(texts, langs)
                    texts, langs, size = [], [], 0
    if texts:
        yield Words(texts, langs)


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    slots, order = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return slots, np.bincount(order, np.concatenate([p[1] for p in parts])).astype(np.int64)


def _packed(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    """(bucket, slots, counts): the slots of each bucket of ``BUCKET`` and their counts as packed integers."""
    slots, n = _merged(parts)
    ends = np.searchsorted(slots, np.arange(1, (1 << SLOT_BITS) // BUCKET + 1) * BUCKET)
    some = np.flatnonzero(np.diff(ends, prepend=0))
    small, cuts = (slots % BUCKET).astype(np.uint16), [(ends[b - 1] if b else 0, ends[b]) for b in some]
    return pa.RecordBatch.from_arrays([
        pa.array(some.astype(np.int32)), pa.array([small[x:y].tobytes() for x, y in cuts], pa.binary()),
        pa.array([n[x:y].tobytes() for x, y in cuts], pa.binary())], ["bucket", "slots", "counts"])


def sieve(rows: DataFrame, least: int, before: list[np.ndarray]) -> np.ndarray:
    """Bitmap of the slots that count at least ``least``, ``2^SLOT_BITS / 8``
    bytes: of words and pairs, or, given that bitmap, of triples and of words in pairs."""
    shared = rows.sparkSession.sparkContext.broadcast(before)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for w in _blocks(batches):
            if not len(w.start):
                continue
            slots = w.slots()
            if shared.value:
                _, pair, triple = w.links(slots, shared.value)
                linked = pair.copy()
                linked[1:] |= pair[:-1]
                found = np.concatenate([slots[2][triple], slots[3][linked]])
            else:
                found = np.concatenate([slots[0], slots[1][w.joined]])
            waiting.append(np.unique(found, return_counts=True))
            size += len(waiting[-1][0])
            if size >= MERGE_SLOTS:
                yield _packed(waiting)
                waiting, size = [], 0
        if waiting:
            yield _packed(waiting)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(BUCKET, np.int64)
        for batch in batches:
            for bucket, slots, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is not None and bucket != now:
                    yield bits(now, total)
                    total[:] = 0
                now = bucket
                total[np.frombuffer(slots, np.uint16)] += np.frombuffer(counts, np.int64)  # slots of a row differ
        if now is not None:
            yield bits(now, total)

    def bits(bucket: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([
            pa.array([bucket], pa.int32()), pa.array([np.packbits(total >= least, bitorder="little").tobytes()], pa.binary())],
            ["bucket", "bits"])

    counts = rows.mapInArrow(count, "bucket int, slots binary, counts binary")
    maps = counts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "bucket int, bits binary")
    out = np.zeros((1 << SLOT_BITS) // 8, np.uint8)
    for bucket, flags in maps.collect():
        out[bucket * BUCKET // 8:(bucket + 1) * BUCKET // 8] = np.frombuffer(flags, np.uint8)
    return out


def _bit(bitmap: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Whether a slot's bit is set."""
    return (bitmap[slots >> 3] >> (slots & 7).astype(np.uint8)) & 1 == 1


def _counted(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by(["bucket", "lang", "gram"]).aggregate([("n", "sum")]).select(
        ["bucket", "lang", "gram", "n_sum"]).rename_columns(["bucket", "lang", "gram", "n"])


def edges(rows: DataFrame, bitmaps: list[np.ndarray], longest: int) -> DataFrame:
    """(lang, gram, n): of every word of the sieved pieces the gram that begins
    there; the empty gram counts all words of the language.

    Grams travel to their bucket as one text (they hold no line feed) with
    packed counts, so that a task ships a few rows and not one per gram.
    """
    shared = rows.sparkSession.sparkContext.broadcast(bitmaps)

    def packed(table: pa.Table) -> pa.RecordBatch:
        table = table.sort_by([("bucket", "ascending"), ("lang", "ascending")])
        bucket, lang, gram = (table.column(c).to_pylist() for c in ("bucket", "lang", "gram"))
        n = table.column("n").to_numpy()
        cuts = [i for i in range(len(n)) if not i or bucket[i] != bucket[i - 1] or lang[i] != lang[i - 1]] + [len(n)]
        spans = list(zip(cuts[:-1], cuts[1:], strict=True))
        return pa.RecordBatch.from_arrays([
            pa.array([bucket[a] for a, _ in spans], pa.int32()), pa.array([lang[a] for a, _ in spans], pa.string()),
            pa.array(["\n".join(gram[a:b]) for a, b in spans], pa.string()),
            pa.array([n[a:b].tobytes() for a, b in spans], pa.binary())], ["bucket", "lang", "grams", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.Table] = []
        for w in _blocks(batches):
            if not len(w.start):
                continue
            good, pair, triple = w.links(w.slots(), shared.value)
            place, reach, on = np.arange(len(good)), pair.astype(np.int64), triple.copy()
            for k in range(1, longest - 1):
                reach += on
                on[:-k] &= triple[k:]
                on[-k:] = False
            first = np.flatnonzero(good)
            last = place[first] + reach[first]
            names = np.array(w.names, object)
            total = np.bincount(w.lang, minlength=len(names))
            some = np.flatnonzero(total)
            waiting.append(_counted([pa.table({
                "bucket": pa.array(np.concatenate([w.buckets(first, last), np.zeros(len(some), np.int32)])),
                "lang": pa.concat_arrays([pa.array(names[w.lang[first]], pa.string()), pa.array(names[some], pa.string())]),
                "gram": pa.concat_arrays([w.grams(first, last), pa.array([""] * len(some), pa.string())]),
                "n": pa.array(np.concatenate([np.ones(len(first), np.int64), total[some]]))})]))
            if sum(t.num_rows for t in waiting) > MERGE_GRAMS:
                waiting = [_counted(waiting)]
                if waiting[0].num_rows > MERGE_GRAMS // 2:
                    yield packed(waiting.pop())
        if waiting:
            yield packed(_counted(waiting))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, size = None, [], 0
        for batch in batches:
            for bucket, lang, grams, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now and waiting:
                    yield from _counted(waiting).drop_columns("bucket").to_batches()
                    waiting, size = [], 0
                now, n = bucket, np.frombuffer(counts, np.int64)
                waiting.append(pa.table({"bucket": pa.array(np.full(len(n), bucket, np.int32)), "lang": pa.repeat(lang, len(n)),
                                         "gram": pa.array(grams.split("\n"), pa.string()), "n": pa.array(n)}))
                size += len(n)
                if size > 4 * MERGE_GRAMS:  # what is left may be as large: then every merge doubles it at most
                    waiting, size = [_counted(waiting)], 0
        if waiting:
            yield from _counted(waiting).drop_columns("bucket").to_batches()

    sent = rows.mapInArrow(run, "bucket int, lang string, grams string, counts binary")
    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(merge, "lang string, gram string, n long")


def _size(gram: Column) -> Column:
    """Words of a gram, as they have one blank between them."""
    return F.when(gram == "", 0).otherwise(F.char_length(gram) - F.char_length(F.replace(gram, F.lit(" "))) + 1)


def flow(grams: DataFrame, longest: int) -> DataFrame:
    """(lang, gram, k, n): counts of all sequences of up to ``longest`` words
    of the sieved pieces, and of all words of a language as k = 0."""
    sized = stored(grams.withColumn("k", _size(F.col("gram"))))
    levels = [sized.where(F.col("k") == longest).select("lang", "gram", "n")]
    for k in range(longest - 1, 0, -1):
        out = levels[-1].select("lang", F.substring_index("gram", " ", k).alias("gram"), "n")
        ends = sized.where(F.col("k") == k).select("lang", "gram", "n")
        levels.append(stored(out.unionByName(ends).groupBy("lang", "gram").agg(F.sum("n").alias("n"))))
    counts = sized.where("k = 0").select("lang", "gram", F.lit(0).alias("k"), "n")
    for k, level in zip(range(longest, 0, -1), levels, strict=True):
        counts = counts.unionByName(level.select("lang", "gram", F.lit(k).alias("k"), "n"))
    return counts


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = 100, longest: int = 5,
                 top: int = 2000) -> DataFrame:
    """The ``top`` phrases of 2 to ``longest`` words of every language that
    occur at least ``least`` times: lang, rank, phrase, a, l, r, n, score.

    Null languages count as ``und``; null and empty texts have no words;
    repeated rows count each; an empty table gives no rows; other columns
    play no part. Equal scores go by count, then by phrase in UTF-8 order.
    """
    rows = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    pairs = sieve(rows, least, [])
    counts = stored(flow(edges(rows, [pairs, sieve(rows, least, [pairs])], longest), longest).where(
        (F.col("k") == 0) | (F.col("n") >= least)))
    phrases = counts.where("k >= 2").select("lang", F.col("gram").alias("phrase"), "k", F.col("n").alias("a"))

    # unary paths: the heaviest candidate that is one word longer
    longer = phrases.where("k > 2").select("lang", "a", F.explode(F.expr(
        "array(substring_index(phrase, ' ', k - 1), substring_index(phrase, ' ', 1 - k))")).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("onward"))
    phrases = phrases.join(longer, ["lang", "phrase"], "left").where("onward is null or onward < a").drop("onward")

    cut = phrases.select("lang", "phrase", "k", "a", F.explode(F.sequence(F.lit(1), F.col("k") - 1)).alias("cut"))
    cut = cut.selectExpr("*", "substring_index(phrase, ' ', cut) AS left", "substring_index(phrase, ' ', cut - k) AS right")
    known = counts.where("k >= 1")
    cut = cut.join(known.select("lang", F.col("gram").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cut = cut.join(known.select("lang", F.col("gram").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    total = counts.where("k = 0").select("lang", "n")
    cut = cut.join(F.broadcast(total) if total.count() <= FEW_LANGS else total, "lang")
    score = F.expr("(cast(a as decimal(18,0)) * cast(n as decimal(16,0)) * cast(1000 as decimal(4,0)))"
                   " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0)))")
    best = cut.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "l", "r", "a", "n")).alias("x"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return best.select("lang", "phrase", "x.score", "x.a", "x.l", "x.r", "x.n").withColumn(
        "rank", F.row_number().over(order)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: The same rows by counting every gram of every size, per :func:`collocations`' contract.
SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
cut AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]'), lambda x: x <> '') AS w FROM pieces),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut),
grams AS (
    SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
    FROM placed, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM grams WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM grams WHERE k > 1 AND f >= 100),
inner_parts AS (
    SELECT DISTINCT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, a
    FROM (SELECT lang, w, a, k, m, unnest(range(1, k - m + 2)) AS i
          FROM candidates, (SELECT unnest(range(2, 5)) AS m) WHERE m < k)),
kept AS (
    SELECT c.* FROM candidates c ANTI JOIN inner_parts p
    ON p.lang = c.lang AND p.phrase = c.phrase AND 100 * p.a >= 100 * c.a),
cuts AS (
    SELECT lang, phrase, a, c, array_to_string(w[1:c], ' ') AS lp, array_to_string(w[c + 1:], ' ') AS rp
    FROM (SELECT *, unnest(range(1, k)) AS c FROM kept)),
scored AS (
    SELECT x.lang, x.phrase, x.a, x.c, l.f AS l, r.f AS r, t.n::BIGINT AS n,
           ((1000::HUGEINT * x.a * t.n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM cuts x JOIN grams l ON l.lang = x.lang AND l.phrase = x.lp JOIN grams r ON r.lang = x.lang AND r.phrase = x.rp
    JOIN total t ON t.lang = x.lang),
lowest AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, c) AS o FROM scored)
SELECT * FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
    FROM lowest WHERE o = 1)
WHERE rank <= 2000
"""
