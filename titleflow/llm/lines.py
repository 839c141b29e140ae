"""Fuzzy line deduplication with DataFrame functions only: MinHash
signatures, banding, the exact comparison and components.

1. One pass cuts every text into lines. A line's shingles are its runs of
   ``width`` characters, one from every character on (a shorter line is its
   own shingle). Without a ``width`` they are cut at its words: a word, the
   next word and the first ``lookahead`` characters of the one after. The
   order of their hashes is the line's MinHash order; the ``sketch``
   first ones (32 bits of each) are its signature. With a ``width``
   those with a first character in ``FIRST`` come before all others, so that
   lines with enough of them need no hash of the rest. One order holds for
   all lines, whichever of their shingles are hashed.
2. Banding: every three neighbouring hashes of the signature make a band
   key. Of two lines with Jaccard similarity s, each hash of their union is
   common with probability s, so at s = 0.8 and eighteen hashes one of the
   sixteen keys or more is shared in 99.9 % of the cases; more above.
   Lines of up to five shingles, where one shingle may part all threes,
   have the keys of two neighbours as well. Two frequent shingles meet in
   lines that have nothing else in common, three hardly ever do.
   Equal lines are put together before, so that a line copied a million
   times is one member of its buckets.
3. Buckets of up to ``CROWD`` members propose each of their pairs, crowded
   ones (copies with small changes, lines around a common template) at
   first the pairs with their smallest and their largest member.
4. The lines of crowded buckets that are not one component by then are
   joined exactly: a line's shingles are put in one order for all lines,
   seldom ones first, and lines with Jaccard similarity s or more share one
   of the first n - ceil(s n) + 1 of their n. Lines of different components
   that share such a shingle are a pair unless its place leaves too few
   shingles behind it. Any order loses nothing, this one keeps the template
   out of the pairs. Shingles of one line only have no row.
5. Of the proposed pairs those stay whose marks (which of 1,024 classes
   hold a shingle) differ in no more places than the lines may have
   shingles of their own; a similar pair never differs in more. The
   rest is verified by the exact Jaccard similarity of their
   whole shingle sets, and the verified links joined to components.
   Where more than ``CROWD`` lines share a shingle of step 4, their pairs
   with the smallest, the largest and the plainest of them (fewest seldom
   shingles) come first, and then all pairs of lines that are not in the
   same component by then.
6. Of every component the first line in (id, row hash, line number) order
   stays.

Bucket sizes are counted map-side, so a bucket of any size is some rows of a
join, never one task's group. Only
hashes, ids and line numbers are shuffled; texts are read again for lines
that are part of a proposed pair. Signatures of lines longer than ``BLOCK``
characters are made in parts. Bytes that are not
UTF-8 count as replacement characters in shingles.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import discard, let, row_key, stored
from titleflow.llm.components import components

#: A lookup of at most this many thin rows or numbers (some 24 bytes each) is broadcast.
BROADCAST_ROWS = 1_000_000
#: Buckets with more members than this are crowded.
CROWD = 32
#: Numbers of a line's mark, 64 bits each (a power of two).
MARKS = 16
#: Characters of a shingle in the registered query and the pipeline.
WIDTH = 9
#: Shingles whose hashes a signature's row holds at a time.
BLOCK = 1 << 17
#: First characters of the character shingles that come first in MinHash order, one in five or so.
FIRST = "acdhlr"


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def shingles(line: Column, lookahead: int = 4, width: int | None = None) -> Column:
    """Distinct 64-bit hashes of a line's shingles: ``width`` characters from
    every character on, or, without it, each word, the next one and
    ``lookahead`` characters of the one after."""
    if width:
        # the matches are empty, so one starts at every character; \P{Cs}: not inside a surrogate pair
        runs = F.regexp_extract_all(line, F.lit(rf"(?s)(?=(\P{{Cs}}{'.' * (width - 1)}))"), F.lit(1))
        return F.array_distinct(F.when(F.char_length(line) < width, F.array(F.xxhash64(line))).otherwise(
            F.transform(runs, lambda x: F.xxhash64(x))))

    def of(w: Column) -> Column:
        return F.array_distinct(F.transform(w, lambda x, i: F.xxhash64(
            x, F.get(w, i + 1), F.substring(F.get(w, i + 2), 1, lookahead))))

    return let(F.split(line, " "), of)


def _windows(code: Column, width: int, first: Column, last: Column) -> Column:
    """Hashes of the runs of ``width`` characters of ``code`` (UTF-32) from characters ``first`` to ``last`` (from 0) on."""
    return F.transform(F.sequence(4 * first + 1, 4 * last + 1, F.lit(4)),
                       lambda at: F.xxhash64(F.substring(code, at, F.lit(4 * width))))


def _code(line: Column) -> Column:
    return F.encode(line, "UTF-32")


def _every_hash(line: Column, lookahead: int, width: int | None) -> Column:
    """The shingle hashes of a line, equal ones more than once; with a ``width`` not those of :func:`shingles`, but cheaper."""
    if not width:
        return shingles(line, lookahead)
    return F.when(F.char_length(line) < width, F.array(F.xxhash64(line))).otherwise(let(
        _code(line), lambda code: _windows(code, width, F.lit(0), _count(code, width) - 1)))


def _hashes(line: Column, lookahead: int, width: int | None) -> Column:
    """The distinct shingle hashes of a line."""
    return F.array_distinct(_every_hash(line, lookahead, width))


def _count(code: Column, width: int) -> Column:
    return F.floor(F.octet_length(code) / 4).cast("int") - (width - 1)


def _smallest(line: Column, start: str, sketch: int, width: int) -> Column:
    """The ``sketch`` smallest distinct hashes of a line's shingles whose first
    character is in the class ``start``, long lines in parts of ``BLOCK``."""
    def low(hashes: Column) -> Column:
        return F.slice(F.array_distinct(F.sort_array(hashes)), 1, sketch)

    def of(part: Column) -> Column:
        # the matches are empty, so one starts at every such character
        runs = F.regexp_extract_all(part, F.lit(rf"(?s)(?=({start}.{{{width - 1}}}))"), F.lit(1))
        return low(F.transform(runs, lambda x: F.hash(x)))

    parts = F.transform(F.sequence(F.lit(1), F.char_length(line), F.lit(BLOCK)),
                        lambda at: of(F.substring(line, at, F.lit(BLOCK + width - 1))))
    return F.when(F.char_length(line) <= BLOCK, of(line)).otherwise(low(F.flatten(parts)))


def with_signature(rows: DataFrame, sketch: int, lookahead: int, width: int | None) -> DataFrame:
    """``rows`` with the ``signature`` of each ``line``: 32 bits of the ``sketch``
    first distinct shingles in MinHash order; none if it is shorter than ``width``."""
    line = F.col("line")
    if not width:
        best = F.slice(F.sort_array(shingles(line, lookahead)), 1, sketch)
        return rows.withColumn("signature", F.transform(
            best, lambda h: (h.bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("int")))
    # a step of its own, so that it is computed once; the others only where they are needed
    rows = rows.withColumn("__first", _smallest(line, f"[{FIRST}]", sketch, width))
    others = _smallest(line, rf"[^{FIRST}\p{{Cs}}]", sketch, width)
    return rows.withColumn("signature", F.when(F.size("__first") >= sketch, F.col("__first")).otherwise(
        F.slice(F.concat("__first", others), 1, sketch))).drop("__first")


def band_keys(signature: Column, sketch: int) -> Column:
    """Keys of every three neighbouring hashes of a signature, up to five
    hashes also of every two; one hash: no key, as only equal lines can be
    similar to such a line. Null where the signature is shorter."""
    def key(first: int, last: int) -> Column:
        return F.xxhash64(*[F.get(signature, F.lit(i)) for i in range(first, last + 1)])

    # written out, as Spark compiles these but no lambda
    size = F.size(signature)
    return F.array(*[F.when(size > i + 2, key(i, i + 2)) for i in range(sketch - 2)],
                   *[F.when((size > i + 1) & (size <= 5), key(i, i + 1)) for i in range(min(4, sketch - 1))])


def _cut(text: Column) -> Column:
    """The lines of a text byte by byte, also where it is not UTF-8; null: one empty line."""
    text = F.coalesce(text, F.lit(""))
    raw = F.transform(F.split(F.decode(text.cast("binary"), "ISO-8859-1"), "\n"),
                      lambda x: F.encode(x, "ISO-8859-1").cast("string"))
    return F.when(F.is_valid_utf8(text), F.split(text, "\n")).otherwise(raw)


def _lines(docs: DataFrame, text: str, *more: Column | str) -> DataFrame:
    """(more..., pos, line): the lines with a word; pos counts all lines from 0."""
    return docs.select(*more, F.posexplode(_cut(F.col(text))).alias("pos", "line")).where(_has_word(F.col("line")))


def line_signatures(rows: DataFrame, text: str, sketch: int, lookahead: int, width: int | None) -> DataFrame:
    """The other columns of ``rows`` and, for every line with a word, ``pos``
    (all lines counted from 0), two hashes ``l1`` (:func:`xxhash64` of the
    line) and ``l2``, and its ``signature``. Null texts have no lines."""
    others = [c for c in rows.columns if c != text]
    return with_signature(_lines(rows, text, *others), sketch, lookahead, width).select(
        *others, "pos", F.xxhash64("line").alias("l1"), F.xxhash64(F.lit(43), "line").alias("l2"), "signature")


def _small(lookup: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(lookup) if rows <= BROADCAST_ROWS else lookup


def _texts(docs: DataFrame, text: str, lines: DataFrame) -> DataFrame:
    """(l1, line): every line in ``lines`` (l1), read from the texts."""
    lines = stored(lines)
    found = _lines(docs, text).select("line", F.xxhash64("line").alias("l1"))
    found = found.join(_small(lines, lines.count()), "l1")
    texts = stored(found.groupBy("l1").agg(F.min("line").alias("line")))
    discard(lines)
    return texts


def _similar(pairs: DataFrame, texts: DataFrame, similarity: float, lookahead: int, width: int | None) -> DataFrame:
    """Those (a, b) of ``pairs`` whose shingle sets have the exact similarity."""
    rows = pairs
    for x in ("a", "b"):
        rows = rows.join(texts.select(F.col("l1").alias(x), F.col("line").alias(f"l{x}")), x)
    sets = rows.select("a", "b", _every_hash(F.col("la"), lookahead, width).alias("s"), _every_hash(F.col("lb"), lookahead, width).alias("t"))
    # written before they are filtered: a filter put below the projection would hash every line once more for each use of its set
    sizes = stored(sets.select("a", "b", F.size(F.array_intersect("s", "t")).alias("common"), F.size(F.array_union("s", "t")).alias("all")))
    return sizes.where(F.col("common") >= similarity * F.col("all")).select("a", "b")


def _keys(signed: DataFrame, sketch: int = 18) -> DataFrame:
    """(l1, key) of (l1, signature)."""
    return signed.select("l1", F.explode(band_keys(F.col("signature"), sketch)).alias("key")).where("key is not null")


def _proposals(keys: DataFrame) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Out of (key, l1): (a, b) of the pairs that meet in buckets, in crowded
    ones those with the smallest and the largest member; the (key, l1) of
    crowded buckets, and the stored tables behind them."""
    buckets = stored(keys.groupBy("key").agg(F.min("l1").alias("lo"), F.max("l1").alias("hi"),
                                             F.count(F.lit(1)).alias("n")).where("n > 1"))
    large = buckets.where("n > 2")
    members = stored(keys.join(_small(large, large.count()), "key"))
    crowd = members.where(f"n > {CROWD}")
    whole = members.where(f"n <= {CROWD}").groupBy("key").agg(F.sort_array(F.collect_list("l1"), asc=False).alias("s"))
    each = whole.select("s", F.posexplode("s").alias("i", "a")).select(
        "a", F.explode(F.slice("s", F.col("i") + 2, F.size("s"))).alias("b"))
    ends = crowd.select("l1", F.explode(F.array("lo", "hi")).alias("y")).where("l1 <> y").select(
        F.greatest("l1", "y").alias("a"), F.least("l1", "y").alias("b"))
    met = buckets.where("n = 2").select(F.col("hi").alias("a"), F.col("lo").alias("b")).unionByName(each).unionByName(ends)
    return met.where("a <> b").distinct(), crowd.select("key", "l1"), [buckets, members]


def _with_root(rows: DataFrame, roots: DataFrame) -> DataFrame:
    """``rows`` (l1...) with the ``root`` of their component, alone: themselves."""
    known = roots.select(F.col("node").alias("l1"), "root")
    return rows.join(known, "l1", "left").withColumn("root", F.coalesce("root", "l1"))


def _split_lines(crowd: DataFrame, roots: DataFrame) -> DataFrame:
    """(l1, root) of the lines of those buckets (key, l1) that are not one component."""
    rows = stored(_with_root(crowd, roots))
    split = rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("key")
    found = stored(rows.join(_small(split, split.count()), "key").select("l1", "root").distinct())
    discard(rows)
    return found


def _marks(texts: DataFrame, lookahead: int, width: int | None) -> DataFrame:
    """(l1, most, m0, m1...): at least as many as a line has different shingles
    and, for 64 ``MARKS`` classes of hashes, whether it holds any of them."""
    if width:
        # rows of an explode, as Spark compiles these but no lambda
        code = texts.select("l1", _code(F.col("line")).alias("code"))
        code = code.select("l1", "code", F.explode(F.sequence(F.lit(0), F.greatest(_count(F.col("code"), width) - 1, F.lit(0)))).alias("at"))
        rows = code.select("l1", F.xxhash64(F.substring(F.col("code"), 4 * F.col("at") + 1, F.lit(4 * width))).alias("h"))
    else:
        rows = texts.select("l1", F.explode(shingles(F.col("line"), lookahead)).alias("h"))
    bit = F.expr("shiftleft(1L, cast(h & 63 as int))")
    of = F.shiftrightunsigned("h", 6).bitwiseAND(F.lit(MARKS - 1))
    return rows.groupBy("l1").agg(F.count(F.lit(1)).cast("int").alias("most"), *[
        F.bit_or(F.when(of == j, bit).otherwise(F.lit(0).cast("long"))).alias(f"m{j}") for j in range(MARKS)])


def _may_match(similarity: float, x: str = "x", y: str = "y") -> Column:
    """Whether lines with the marks ``x`` and ``y`` can be similar: every class
    that only one has holds a shingle that the other lacks."""
    differ = reduce(add, [F.bit_count(F.col(f"{x}.m{i}").bitwiseXOR(F.col(f"{y}.m{i}"))) for i in range(MARKS)])
    return differ <= (1 - similarity) / (1 + similarity) * (F.col(f"{x}.most") + F.col(f"{y}.most")) + 1e-6


def _sifted(pairs: DataFrame, marks: DataFrame, similarity: float) -> DataFrame:
    """Those (a, b) of ``pairs`` whose marks allow the similarity."""
    rows = pairs
    for name, end in (("x", "a"), ("y", "b")):
        rows = rows.join(marks.select(F.col("l1").alias(end), F.struct("most", *[f"m{i}" for i in range(MARKS)]).alias(name)), end)
    return stored(rows.where(_may_match(similarity)).select("a", "b"))


def _seldom(texts: DataFrame, similarity: float, lookahead: int, width: int | None) -> DataFrame:
    """(l1, size, plain, key, at): of every line's ``size`` shingles, seldom
    ones first, those of which a similar line must share one, with their
    places from 1; ``plain`` grows with the mean frequency of its shingles.
    Shingles of one line only have no row."""
    sets = stored(texts.select("l1", _hashes(F.col("line"), lookahead, width).alias("s")))
    rows = sets.select("l1", F.size("s").alias("size"), F.explode("s").alias("key"))
    often = stored(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = rows.join(_small(often, often.count()), "key").groupBy("l1").agg(
        F.max("size").alias("size"), F.sort_array(F.collect_list(F.struct("n", "key"))).alias("s"),
        F.sum(F.log2("n")).alias("weight"))
    first = F.col("size") - F.ceil(similarity * F.col("size") - 1e-9).cast("int") + 1
    alone = F.col("size") - F.size("s")
    cut = shared.select("l1", "size", (F.col("weight") / F.col("size")).alias("plain"), alone.alias("alone"), F.posexplode(
        F.slice("s", F.lit(1), F.greatest(first - alone, F.lit(0)))).alias("i", "x"))
    out = stored(cut.select("l1", "size", "plain", F.col("x.key").alias("key"), (F.col("alone") + F.col("i") + 1).alias("at")))
    discard(sets)
    discard(often)
    return out


def _may_be_similar(similarity: float) -> Column:
    """Whether the lines of x and y (l1, size, at) can be similar if the
    shingle at ``at`` is the first one that they share."""
    least = similarity / (1 + similarity) * (F.col("x.size") + F.col("y.size"))
    return F.least(F.col("x.size") - F.col("x.at"), F.col("y.size") - F.col("y.at")) + 1 >= least - 1e-9


def _crowd_members(texts: DataFrame, similarity: float, lookahead: int, width: int | None) -> DataFrame:
    """(key, l1, size, plain, at, n): the lines that share a seldom shingle with another and how many do."""
    rows = _seldom(texts, similarity, lookahead, width)
    buckets = stored(rows.groupBy("key").agg(F.count(F.lit(1)).cast("int").alias("n")).where("n > 1"))
    members = stored(rows.join(_small(buckets, buckets.count()), "key"))
    discard(rows)
    discard(buckets)
    return members


def _crowd_pairs(members: DataFrame, split: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of members that share a shingle, may be similar and are not in
    the same component of ``split`` (l1, root): all pairs of up to ``CROWD``
    lines, of more those with the smallest, the largest and the plainest."""
    rows = members.join(split, "l1").select("key", "n", "plain", F.struct("l1", "size", "at", "root").alias("x"))
    few = rows.where(f"n <= {CROWD}").groupBy("key").agg(F.sort_array(F.collect_list("x"), asc=False).alias("s"),
                                                         F.min("x.root").alias("lo"), F.max("x.root").alias("hi"))
    each = few.where("lo <> hi").select("s", F.posexplode("s").alias("i", "x")).select(
        "x", F.explode(F.slice("s", F.col("i") + 2, F.size("s"))).alias("y"))
    many = rows.where(f"n > {CROWD}")
    ends = many.groupBy("key").agg(F.array(F.min("x"), F.max("x"), F.max(F.struct("plain", "x"))["x"]).alias("ends"))
    hubs = many.join(ends, "key").select("x", F.explode("ends").alias("y"))
    met = each.unionByName(hubs).where("x.root <> y.root").where(_may_be_similar(similarity))
    return met.select(F.greatest("x.l1", "y.l1").alias("a"), F.least("x.l1", "y.l1").alias("b")).distinct()


def _rest_pairs(members: DataFrame, marks: DataFrame, roots: DataFrame, similarity: float) -> DataFrame:
    """(a, b) of all members of crowded buckets that share a shingle, may be
    similar by its places and their ``marks`` and are not in the same
    component of ``roots`` (node, root)."""
    bits = [f"m{i}" for i in range(MARKS)]
    crowd = members.where(f"n > {CROWD}").select("key", "l1", "size", "at").join(marks, "l1").select(
        "key", F.struct("l1", "size", "at", "most", *bits).alias("x"))
    apart = stored(crowd.join(roots, F.col("x.l1") == F.col("node"), "left").select(
        "key", "x", F.coalesce("root", "x.l1").alias("root")))
    sizes = apart.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    # pairs inside a bucket's largest component are never made
    main = sizes.groupBy("key").agg(F.max(F.struct("n", "root")).alias("m"), F.count(F.lit(1)).alias("k")).where(
        "k > 1").select("key", F.col("m.root").alias("main"))
    split = apart.join(main, "key")
    pairs = split.where("root <> main").join(
        split.select("key", F.col("x").alias("y"), F.col("root").alias("other")), "key").where(
        "root <> other and (other = main or x.l1 > y.l1)").where(_may_be_similar(similarity)).where(_may_match(similarity))
    pairs = stored(pairs.select(F.greatest("x.l1", "y.l1").alias("a"), F.least("x.l1", "y.l1").alias("b")).distinct())
    discard(apart)
    return pairs


def _links(docs: DataFrame, text: str, distinct: DataFrame, similarity: float, lookahead: int, sketch: int,
           width: int | None) -> DataFrame:
    """(a, b) that join the components of the lines (l1, signature) by verified links."""
    pairs, crowd, behind = _proposals(_keys(distinct, sketch))
    pairs = stored(pairs)
    texts = _texts(docs, text, pairs.select(F.explode(F.array("a", "b")).alias("l1")).distinct())
    marks = stored(_marks(texts, lookahead, width))
    sifted = _sifted(pairs, marks, similarity)
    links = _similar(sifted, texts, similarity, lookahead, width)
    for t in (pairs, sifted):
        discard(t)
    if not crowd.isEmpty():
        # every member of a crowded bucket is in a pair, so its text and its mark are there
        links = _crowd_links(crowd, texts, marks, links, similarity, lookahead, width)
    for t in (texts, marks, *behind):
        discard(t)
    return links


def _stars(roots: DataFrame) -> DataFrame:
    """(a, b): the links of every line to the root of its component."""
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b"))


def _crowd_links(crowd: DataFrame, texts: DataFrame, marks: DataFrame, links: DataFrame, similarity: float,
                 lookahead: int, width: int | None) -> DataFrame:
    """(a, b) that join what ``links`` join and the lines of crowded buckets (key, l1) that they leave apart."""
    roots = components(links)
    split = _split_lines(crowd, roots)
    if split.isEmpty():
        return _stars(roots)
    members = _crowd_members(texts.join(split.select("l1"), "l1", "left_semi"), similarity, lookahead, width)
    pairs = stored(_crowd_pairs(members, split, similarity))
    sifted = _sifted(pairs, marks, similarity)
    links = _stars(roots).unionByName(_similar(sifted, texts, similarity, lookahead, width))
    discard(pairs)
    discard(sifted)
    if not members.where(f"n > {CROWD}").isEmpty():
        roots = components(links)
        rest = _rest_pairs(members, marks, roots, similarity)
        links = _stars(roots).unionByName(_similar(rest, texts, similarity, lookahead, width))
        discard(rest)
    discard(members)
    discard(split)
    return links


def line_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = 0.8,
                    lookahead: int = 4, sketch: int = 18, width: int | None = None) -> DataFrame:
    """One row per line with a word: ``__h1``, ``__h2`` (the row's key),
    ``doc``, ``pos`` and, of the first line of its component, ``first``
    (struct nodoc, doc, h1, h2, pos); ``kept`` says that it is that line.

    Null and empty texts and lines without a word have no rows; a null id
    comes after all others; wholly equal rows share their key and count as
    one document; an empty table gives no rows. Clashing names of extra
    columns do no harm. Only lines of ``width`` characters or more, or of
    two shingles or more, can be similar without being equal.
    """
    rows = stored(line_signatures(docs.select(*row_key(docs), F.col(id_col).alias("doc"), F.col(text).alias("__text")),
                                  "__text", sketch, lookahead, width))
    distinct = stored(rows.groupBy("l1").agg(F.first("signature").alias("signature"), F.count(F.lit(1)).alias("n")))
    signed = distinct.where("size(signature) > 1").select("l1", "signature")
    roots = components(_links(docs, text, signed, similarity, lookahead, sketch, width))

    # only lines with links or copies are grouped; one without links is told from another with the same 64 bits by 64 more
    linked = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    copied = distinct.where("n > 1").select(F.col("l1").alias("node"), F.lit(None).cast("long").alias("root"))
    grouped = stored(linked.unionByName(copied).groupBy("node").agg(F.max("root").alias("root")))
    discard(distinct)
    lines = rows.join(_small(grouped, grouped.count()), rows.l1 == grouped.node, "left").select(
        "__h1", "__h2", "doc", "pos", F.isnotnull("node").alias("member"), F.coalesce("root", "l1").alias("g1"),
        F.when(F.col("root").isNull(), F.col("l2")).otherwise(F.lit(0)).alias("g2"))
    place = F.struct(F.isnull("doc").alias("nodoc"), F.col("doc"), F.col("__h1").alias("h1"),
                     F.col("__h2").alias("h2"), F.col("pos"))
    first = lines.where("member").groupBy("g1", "g2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    first = stored(first.where("n > 1").drop("n"))
    out = lines.join(_small(first, 2 * first.count()), ["g1", "g2"], "left")
    own = F.struct(F.isnull("doc").alias("nodoc"), F.col("doc"), F.col("__h1").alias("h1"),
                   F.col("__h2").alias("h2"), F.col("pos"))
    return out.select("__h1", "__h2", "doc", "pos", F.coalesce("first", own).alias("first"),
                      (F.col("first").isNull() | (F.col("first") == own)).alias("kept"))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", similarity: float = 0.8,
                lookahead: int = 4, sketch: int = 18, chars: str | None = None, width: int | None = None) -> DataFrame:
    """``docs`` without the repeated lines, columns unchanged.

    Lines without a word stay where they are. A text that loses no line is
    unchanged (null stays null); a document whose lines with words all go
    is itself a copy and goes; documents without a word stay. Wholly equal
    rows count as one document and are treated alike. ``chars`` names a
    column that holds the text's length and follows it.
    """
    found = line_components(docs, id_col, text, similarity, lookahead, sketch, width)
    gone = stored(found.groupBy("__h1", "__h2").agg(
        F.collect_set(F.when(~F.col("kept"), F.col("pos"))).alias("__gone"),
        F.max(F.col("kept").cast("int")).alias("__some")).where(F.size("__gone") > 0))
    size = gone.agg(F.sum(F.size("__gone") + 3)).first()[0] or 0
    rows = docs.select("*", *row_key(docs)).join(_small(gone, size), ["__h1", "__h2"], "left")
    rows = rows.where(F.coalesce(F.col("__some"), F.lit(1)) == 1)

    new = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(
        let(F.split(F.col(text), "\n"), lambda ls: let(
            F.array_except(F.sequence(F.lit(0), F.size(ls) - 1), F.col("__gone")),
            lambda keep: F.array_join(F.transform(keep, lambda i: F.get(ls, i)), "\n"))))
    out = rows.withColumn(text, new)
    if chars:
        out = out.withColumn(chars, F.when(F.col("__gone").isNull(), F.col(chars)).otherwise(
            F.char_length(text).cast(docs.schema[chars].dataType)))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
