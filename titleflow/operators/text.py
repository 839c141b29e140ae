"""Title text operators.

Per-row work is done with native array expressions. Where a title's tokens
must meet a lookup table (vocabulary ids, token vectors, lemmas, blocked
tokens), a table whose rows and bytes are checked to be small travels to
the executors whole and answers one Arrow batch of token lists at a time
(:func:`_looked_up`): no explode, no shuffle. Above the bound the tokens
are exploded with their position, joined through
:func:`~titleflow.operators.joins.lookup_join` (salted shuffle) and
regrouped per title in position order. The regroup shuffles token rows by
title; a group is one title, whose length is already bounded by the stage
that truncates it (encode, embed) or by the row itself (clean).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from titleflow.functions.arrays import fit_length
from titleflow.functions.text import tokenize_words
from titleflow.operators.joins import lookup_join
from titleflow.operators.wordlists import (ENGLISH_STOP_WORDS, NOUN_SUFFIX_RULES,
                                           PUNCTUATION)
from titleflow.session import cut_lineage

_POS = "__tf_pos"
_TOK = "__tf_tok"
_ROW = "__tf_row"

#: A lookup table of at most this many rows and bytes is sent to the executors whole.
LOOKUP_ROWS = 200_000
LOOKUP_BYTES = 64 << 20


def token_blocklist(stop: Sequence[str] | None = None,
                    punct: Sequence[str] | None = None) -> list[str]:
    """Distinct union of stop words and punctuation (parameters; defaults
    are the English stop words and ASCII punctuation)."""
    stop = ENGLISH_STOP_WORDS if stop is None else stop
    punct = PUNCTUATION if punct is None else punct
    return sorted(set(stop) | set(punct))


def token_blocklist_table(stop: DataFrame, punct: DataFrame) -> DataFrame:
    """Table form of :func:`token_blocklist` for lists too big for a literal."""
    a = stop.select(F.col(stop.columns[0]).alias("token"))
    b = punct.select(F.col(punct.columns[0]).alias("token"))
    return a.union(b).distinct()


def explode_values(df: DataFrame, array_col: str, out: str, *,
                   keep: Sequence[str] = ()) -> DataFrame:
    """One row per non-NULL array element (plus the ``keep`` columns), as
    ``explode`` - written as ``explode_outer`` plus a NULL filter so that
    the optimizer does not infer a ``size(array) > 0`` filter below a
    repartition, which would evaluate a tokeniser expression twice."""
    return (df.select(*keep, F.explode_outer(F.col(array_col)).alias(out))
            .where(F.col(out).isNotNull()))


def _one_per_key(table: DataFrame, key: str, value: str) -> DataFrame:
    """``(key, value)`` with one row per key, the smallest value of repeated
    ones, so that a lookup answers alike whichever way it is made."""
    return table.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(value))


def _small_table(table: DataFrame, key: str, value: str) -> pa.Table | None:
    """``(key, value)`` as Arrow data, or None above :data:`LOOKUP_ROWS` or
    :data:`LOOKUP_BYTES`, which one job checks before anything is fetched."""
    rows = table.select(F.col(key).alias("key"), F.col(value).alias("value")).where(F.col("key").isNotNull())
    kind = rows.schema["value"].dataType
    width = F.lit(8) if not isinstance(kind, ArrayType) else 8 * F.size("value")
    if kind.simpleString() == "string":
        width = F.octet_length("value")
    n, size = rows.limit(LOOKUP_ROWS + 1).agg(
        F.count(F.lit(1)), F.sum(F.octet_length("key") + F.coalesce(width, F.lit(0)))).first()
    return rows.toArrow() if n <= LOOKUP_ROWS and (size or 0) <= LOOKUP_BYTES else None


def _looked_up(df: DataFrame, tokens: Column, table: DataFrame, key: str, value: str) -> Column | None:
    """Array of the table's values for a token array (NULL where the token
    is not in the table), or None for a table that is too large."""
    small = _small_table(table, key, value)
    if small is None:
        return None
    shared = df.sparkSession.sparkContext.broadcast(small.combine_chunks())

    @F.arrow_udf(ArrayType(table.schema[value].dataType))
    def look(lists: pa.Array) -> pa.Array:
        known = shared.value
        at = pc.index_in(lists.flatten(), value_set=known["key"])
        found = known["value"].take(at).combine_chunks()
        if isinstance(found, pa.ChunkedArray):
            found = pa.concat_arrays(found.chunks) if found.num_chunks else pa.array([], found.type)
        sizes = pc.fill_null(pc.list_value_length(lists), 0)
        ends = pc.cumulative_sum(sizes).cast(pa.int32())
        starts = pa.concat_arrays([pa.array([0], pa.int32()), ends])
        return pa.ListArray.from_arrays(starts, found)

    return look(F.coalesce(tokens, F.array().cast("array<string>")))


def _with_row(df: DataFrame) -> DataFrame:
    """Adds a hash over the whole row, which tells rows with equal or NULL
    keys apart when their tokens are regrouped."""
    return df.withColumn(_ROW, F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields
                                            if "map<" not in f.dataType.simpleString()]))


def _explode_tokens(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, row hash if present, pos, token) rows; a title without tokens
    keeps one row with NULL pos so that it survives the regroup."""
    row = [_ROW] if _ROW in df.columns else []
    return df.select(key, *row, F.posexplode_outer(tokens).alias(_POS, _TOK))


def _regroup(exploded: DataFrame, key: str, value: Column, out: str,
             carry: DataFrame | None = None) -> DataFrame:
    """Collect ``value`` per input row in position order.

    Rows are told apart by key and row hash (:func:`_with_row`), so NULL
    and repeated keys keep their rows and spread; wholly equal rows, whose
    items are equal too, are collected once and repeated as often as they
    came in. ``carry`` (the input table) brings every title back, also one
    whose tokens were all dropped, together with its other columns. It
    joins the regroup as one extra row per title (a UNION ALL into the same
    aggregation), so the other columns travel once per title - never once
    per token, and without a join back to the input.
    """
    item = F.when(F.col(_POS).isNotNull(), F.struct(F.col(_POS).alias("p"), value.alias("v")))
    first = F.lit(0) if carry is not None else (F.coalesce(F.col(_POS), F.lit(0)) == 0).cast("int")
    items = exploded.select(key, _ROW, item.alias("__tf_item"), first.alias("__tf_copy"))
    extra = [c for c in (carry.columns if carry is not None else []) if c not in (key, _ROW)]
    if carry is not None:
        item_type = items.schema["__tf_item"].dataType
        packed = carry.select(key, _ROW, F.lit(None).cast(item_type).alias("__tf_item"), F.lit(1).alias("__tf_copy"),
                              *([F.struct(*extra).alias("__tf_carry")] if extra else []))
        if extra:
            items = items.withColumn("__tf_carry", F.lit(None).cast(packed.schema["__tf_carry"].dataType))
        items = items.unionByName(packed)
    aggs = [F.array_sort(F.array_distinct(F.collect_list("__tf_item"))).alias("__tf_items"),
            F.sum("__tf_copy").cast("int").alias("__tf_copies")]
    if extra:
        aggs.append(F.first("__tf_carry", ignorenulls=True).alias("__tf_carry"))
    agg = items.groupBy(key, _ROW).agg(*aggs)
    cols = [key] + [F.col(f"__tf_carry.`{c}`").alias(c) for c in extra]
    one = agg.select(*cols, F.transform("__tf_items", lambda s: s["v"]).alias(out), "__tf_copies")
    return one.withColumn("__tf_copies", F.explode(F.sequence(F.lit(1), "__tf_copies"))).drop("__tf_copies")


def remove_tokens(df: DataFrame, tokens: str, blocklist: Sequence[str] | DataFrame | None = None,
                  *, out: str | None = None, key: str = "Id",
                  strategy: str = "array") -> DataFrame:
    """Drop every token whose lower-case form is in ``blocklist``.

    ``strategy='array'``: a per-row ``filter`` with an ``IN`` list that
    Catalyst turns into a hash set (no shuffle); for word lists.
    ``strategy='join'``: for block tables too large for a literal; looked
    up per batch when small, otherwise explode, anti-join, regroup.
    NULL tokens stay and a NULL list becomes empty, whichever way is taken.
    """
    out = out or tokens
    block = token_blocklist() if blocklist is None else blocklist
    if strategy == "array":
        if isinstance(block, DataFrame):
            raise ValueError("strategy='array' needs a list; use strategy='join'")
        words = sorted(set(block))
        return df.withColumn(out, F.filter(F.coalesce(F.col(tokens), F.array().cast("array<string>")),
                                           lambda t: t.isNull() | ~F.lower(t).isin(words)))
    if strategy != "join":
        raise ValueError("strategy must be 'array' or 'join'")
    table = (block if isinstance(block, DataFrame)
             else df.sparkSession.createDataFrame([(w,) for w in sorted(set(block))], "token string"))
    table = table.select(F.col(table.columns[0]).alias("__tf_low")).distinct()
    found = _looked_up(df, F.transform(F.col(tokens), F.lower), table, "__tf_low", "__tf_low")
    if found is not None:
        hits = df.withColumn("__tf_hits", found)
        return hits.withColumn(out, F.filter(F.coalesce(F.col(tokens), F.array().cast("array<string>")),
                                             lambda t, i: F.get("__tf_hits", i).isNull())).drop("__tf_hits")
    df = _with_row(df)
    ex = _explode_tokens(df, key, F.col(tokens)).withColumn("__tf_low", F.lower(_TOK))
    kept = lookup_join(ex, table, "__tf_low", how="left_anti", salt_by=[key, _POS])
    return _regroup(kept, key, F.col(_TOK), out, carry=df.drop(out))


def suffix_lemmas(tokens: DataFrame, dictionary: DataFrame, *,
                  rules: Sequence[tuple[str, str]] = NOUN_SUFFIX_RULES,
                  exceptions: DataFrame | None = None) -> DataFrame:
    """Lemma table ``(token, lemma)`` from suffix rules checked against a
    dictionary, the way WordNet's noun lemmatiser works: every rule whose
    suffix ends the token proposes ``stem + replacement``; proposals found
    in ``dictionary`` are kept and the shortest wins (then alphabetical);
    a token that is itself in the dictionary beats proposals of its own
    length. Tokens without a winning proposal are left out (they map to
    themselves).

    ``exceptions`` is a table ``(token, lemma)`` of irregular forms, which
    is asked first: a token that it lists takes its lemma from there
    (repeated tokens: the smallest) and no rule is tried on it.

    ``tokens`` and ``dictionary`` are one-column tables; both are reduced
    to distinct values first (partial aggregation absorbs hot tokens).
    """
    toks = tokens.select(F.col(tokens.columns[0]).alias("token")).distinct()
    dic = dictionary.select(F.col(dictionary.columns[0]).alias("lemma")).distinct()
    irregular = None
    if exceptions is not None:
        known = _one_per_key(exceptions.select("token", "lemma"), "token", "lemma")
        irregular = toks.join(known, "token").select("token", "lemma")
        toks = toks.join(known.select("token"), "token", "left_anti")
    # all rules in one projection: one pass over the distinct tokens
    proposals = [
        F.when(F.col("token").endswith(suffix) & (F.length("token") > len(suffix)),
               F.concat(F.expr(f"substring(token, 1, length(token) - {len(suffix)})"), F.lit(repl)))
        for suffix, repl in rules
    ]
    cand = explode_values(toks.select("token", F.array(*proposals).alias("__tf_p")), "__tf_p",
                          "lemma", keep=["token"])
    found = cand.join(dic, on="lemma", how="left_semi")
    best = found.groupBy("token").agg(
        F.min(F.struct(F.length("lemma").alias("n"), F.col("lemma").alias("l"))).alias("b"))
    # a token that is itself a dictionary word is one of the candidates and
    # comes first among equally short ones ("women" stays when it is listed)
    listed = toks.join(dic.select(F.col("lemma").alias("token")), on="token", how="left_semi") \
        .withColumn("__tf_listed", F.lit(True))
    best = best.join(listed, on="token", how="left").where(
        F.col("__tf_listed").isNull() | (F.col("b.n") < F.length("token")))
    best = best.select("token", F.col("b.l").alias("lemma"))
    return best if irregular is None else best.unionByName(irregular)


def lemmatize(df: DataFrame, tokens: str, lemmas: DataFrame, *, out: str | None = None,
              key: str = "Id") -> DataFrame:
    """Replace each token by its lemma from the ``(token, lemma)`` table;
    tokens missing from the table stay as they are. Of a token that the
    table repeats the smallest lemma counts; NULL tokens stay, a NULL list
    becomes an empty one."""
    out = out or tokens
    lemmas = _one_per_key(lemmas.select("token", "lemma"), "token", "lemma")
    found = _looked_up(df, F.col(tokens), lemmas, "token", "lemma")
    if found is not None:
        listed = F.coalesce(F.col(tokens), F.array().cast("array<string>"))
        return df.withColumn("__tf_lemmas", found).withColumn(
            out, F.zip_with("__tf_lemmas", listed, lambda m, t: F.coalesce(m, t))).drop("__tf_lemmas")
    df = _with_row(df)
    ex = _explode_tokens(df, key, F.col(tokens))
    lt = lemmas.select(F.col("token").alias(_TOK), F.col("lemma").alias("__tf_lemma"))
    joined = lookup_join(ex, lt, _TOK, how="left", salt_by=[key, _POS])
    return _regroup(joined, key, F.coalesce(F.col("__tf_lemma"), F.col(_TOK)), out,
                    carry=df.drop(out))


def joined_text(tokens: Column | str) -> Column:
    """Tokens joined by one space, each followed by a space (so a trailing
    space when non-empty), ``''`` when empty."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    return F.when(F.size(t) > 0, F.concat(F.concat_ws(" ", t), F.lit(" "))).otherwise(F.lit(""))


def clean(df: DataFrame, title: str = "Title", *, blocklist: Sequence[str] | None = None,
          lemmas: DataFrame | None = None, key: str = "Id",
          out_text: str = "clean_text", out_tokens: str = "clean_tokens",
          words_of: Callable[[Column], Column] = tokenize_words) -> DataFrame:
    """Title cleaning: word-tokenise (``words_of``, for example
    :func:`~titleflow.functions.text.tokenize_treebank`), drop blocked
    tokens (compared in lower case, output keeps case), lemmatise, and
    return both the token list and the space-joined text with its trailing
    space."""
    block = token_blocklist() if blocklist is None else list(blocklist)
    words = sorted(set(block))
    staged = df.withColumn(out_tokens, F.filter(words_of(F.col(title)),
                                                lambda t: ~F.lower(t).isin(words)))
    if lemmas is not None:
        staged = lemmatize(staged, out_tokens, lemmas, key=key)
    return staged.withColumn(out_text, joined_text(out_tokens))


def build_vocab(df: DataFrame, tokens: str, size: int | None = None, *, n_specials: int = 4,
                min_count: int = 1) -> DataFrame:
    """Vocabulary ``(token, id, count)`` of all tokens, most frequent first,
    ties broken by token; ids start after the ``n_specials`` reserved ids
    (pad 0, start 1, end 2, unknown 3 by default). ``size`` keeps only the
    most frequent ones.

    Counting is a partial + final aggregate (a hot token only bumps
    map-side counters). The full vocabulary is range-partitioned by (count,
    token), sorted inside the partitions and written once; a token's id is
    its partition's offset plus its place there, so no task numbers the
    whole table and the many tokens with count 1 are spread. A top-k is a
    distributed take-ordered, and only its rows are numbered.
    """
    counts = (explode_values(df, tokens, "token")
              .groupBy("token").agg(F.count(F.lit(1)).alias("count"))
              .where(F.col("count") >= min_count))
    if size is None:
        return _numbered(counts, n_specials)
    top = counts.orderBy(F.desc("count"), F.asc("token")).limit(size)
    from pyspark.sql import Window
    w = Window.orderBy(F.desc("count"), F.asc("token"))
    return top.select("token", (F.row_number().over(w) - 1 + n_specials).cast("int").alias("id"),
                      F.col("count").cast("long").alias("count"))


def _numbered(counts: DataFrame, first: int) -> DataFrame:
    """``(token, id, count)`` in (count descending, token) order from ``first``."""
    from pyspark.sql import Window
    order = [F.desc("count"), F.asc("token")]
    dealt = counts.repartitionByRange(*order).sortWithinPartitions(*order)
    # the high bits of this id are the partition, the low 33 bits the place
    placed = cut_lineage(dealt.withColumn("__tf_at", F.monotonically_increasing_id()))
    placed = placed.select("token", "count", F.shiftright("__tf_at", 33).alias("__tf_part"),
                           F.col("__tf_at").bitwiseAND(F.lit((1 << 33) - 1)).alias("__tf_place"))
    sizes = placed.groupBy("__tf_part").agg(F.count(F.lit(1)).alias("n"))  # one row per partition
    before = Window.orderBy("__tf_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__tf_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__tf_off"))
    return placed.join(F.broadcast(offsets), "__tf_part").select(
        "token", (F.col("__tf_off") + F.col("__tf_place") + first).cast("int").alias("id"),
        F.col("count").cast("long").alias("count"))


def encode(df: DataFrame, tokens: str, vocab: DataFrame, *, key: str = "Id",
           max_len: int = 64, start_id: int | None = 1, end_id: int | None = 2,
           pad_id: int = 0, unk_id: int = 3, vocab_rows: int | None = None,
           ids: str = "input_ids", mask: str = "attention_mask") -> DataFrame:
    """Title tokens -> fixed-length ``input_ids`` and ``attention_mask``.

    Truncate to ``max_len`` minus the specials *before* exploding, look the
    tokens up (unknown -> ``unk_id``), add start/end ids, pad with
    ``pad_id``. The mask comes from the real length, never from comparing
    ids with ``pad_id`` (the pad id may equal the end id). Returns ``key``,
    ``ids``, ``mask`` and ``n_tokens`` (real length incl. specials).
    """
    n_spec = int(start_id is not None) + int(end_id is not None)
    if max_len < n_spec:
        raise ValueError("max_len too small for the special ids")
    trunc = df.select(key, F.slice(F.coalesce(F.col(tokens), F.array().cast("array<string>")),
                                   1, max_len - n_spec).alias(_TOK + "s"))
    v = _one_per_key(vocab.select(F.col("token").alias(_TOK), F.col("id").cast("int").alias("__tf_id")), _TOK, "__tf_id")
    found = _looked_up(trunc, F.col(_TOK + "s"), v, _TOK, "__tf_id")
    if found is not None:
        reg = trunc.select(key, found.alias("__tf_ids")).withColumn(
            "__tf_ids", F.transform("__tf_ids", lambda i: F.coalesce(i, F.lit(unk_id))))
    else:
        # written once: the hot keys' passes and the join read at most ``max_len`` tokens a
        # title instead of tokenising the texts again
        ex = _explode_tokens(_with_row(cut_lineage(trunc)), key, F.col(_TOK + "s"))
        joined = lookup_join(ex, v, _TOK, how="left", known_rows=vocab_rows, salt_by=[key, _POS])
        reg = _regroup(joined, key, F.coalesce(F.col("__tf_id"), F.lit(unk_id)), "__tf_ids")
    body = F.col("__tf_ids")
    if start_id is not None:
        body = F.concat(F.array(F.lit(start_id)), body)
    if end_id is not None:
        body = F.concat(body, F.array(F.lit(end_id)))
    n_real = F.size(body)
    return reg.select(
        key,
        fit_length(body, max_len, pad_id).alias(ids),
        F.transform(F.sequence(F.lit(1), F.lit(max_len)),
                    lambda i: F.when(i <= n_real, 1).otherwise(0)).alias(mask),
        n_real.alias("n_tokens"))


def token_vectors_from_vocab(vocab: DataFrame, vectors: DataFrame, *, vocab_id: str = "rank",
                             vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(token, vector)`` by pairing the i-th vocabulary word with row i of
    a vector table (how the driver tables stand in for pretrained vectors)."""
    return vocab.join(vectors.select(F.col(vec_id).alias(vocab_id), F.col(vector).alias("vector")),
                      on=vocab_id, how="inner").select("token", "vector")


def embed_tokens(df: DataFrame, tokens: str, vectors: DataFrame, dim: int, *,
                 key: str = "Id", length: int = 15, vectors_rows: int | None = None,
                 out: str = "embedded") -> DataFrame:
    """Title -> ``length`` x ``dim`` matrix of token vectors.

    Tokens are padded with ``''`` or cut to ``length`` first; unknown and
    pad tokens get the zero vector. Returns ``key``, ``out`` and
    ``n_known`` (tokens that had a vector).
    """
    fitted = df.select(key, fit_length(F.col(tokens), length, "").alias(_TOK + "s"))
    vt = vectors.select(F.col("token").alias(_TOK),
                        F.col("vector").cast("array<float>").alias("__tf_vec")).where(F.col(_TOK) != "")
    vt = _one_per_key(vt, _TOK, "__tf_vec")
    found = _looked_up(fitted, F.col(_TOK + "s"), vt, _TOK, "__tf_vec")
    if found is not None:
        zeros = F.array_repeat(F.lit(0.0).cast("float"), dim)
        return fitted.select(key, found.alias("__tf_m")).select(
            key, F.transform("__tf_m", lambda x: F.coalesce(x, zeros)).alias(out),
            F.size(F.filter("__tf_m", lambda x: x.isNotNull())).alias("n_known"))
    ex = _explode_tokens(_with_row(fitted), key, F.col(_TOK + "s"))
    joined = lookup_join(ex, vt, _TOK, how="left", known_rows=vectors_rows, salt_by=[key, _POS])
    zero = F.array_repeat(F.lit(0.0).cast("float"), dim)
    known = F.col("__tf_vec").isNotNull().cast("int")
    j2 = joined.withColumn("__tf_v", F.struct(F.coalesce(F.col("__tf_vec"), zero).alias("x"),
                                              known.alias("k")))
    reg = _regroup(j2, key, F.col("__tf_v"), "__tf_m")
    return reg.select(key, F.transform("__tf_m", lambda s: s["x"]).alias(out),
                      F.aggregate("__tf_m", F.lit(0), lambda a, s: a + s["k"]).alias("n_known"))


def matrix_features(matrix: Column | str, dim: int, mode: str = "mean") -> Column:
    """A title matrix (rows of ``dim`` floats) -> one fixed-length vector:
    ``mode='mean'`` averages the rows (``dim`` values), ``mode='concat'``
    flattens them (``rows * dim`` values, order kept)."""
    m = F.col(matrix) if isinstance(matrix, str) else matrix
    if mode == "concat":
        return F.flatten(m)
    if mode != "mean":
        raise ValueError("mode must be 'mean' or 'concat'")
    n = F.greatest(F.size(m), F.lit(1)).cast("double")
    return F.transform(F.sequence(F.lit(0), F.lit(dim - 1)),
                       lambda i: F.aggregate(m, F.lit(0.0).cast("double"),
                                             lambda a, v: a + F.get(v, i)) / n)


def length_profile(df: DataFrame, tokens: str) -> DataFrame:
    """Mean, max, min and exact median of the token count per title.

    Exact without one task holding all values: the counts are first
    reduced to a histogram ``(length, rows)`` (partial aggregation; at most
    one row per distinct length) and the statistics, including the median
    from cumulative counts, are read off that small table.
    """
    from pyspark.sql import Window
    hist = (df.select(F.size(F.col(tokens)).alias("len"))
            .groupBy("len").agg(F.count(F.lit(1)).alias("cnt")))
    w = Window.orderBy("len").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    h = hist.select("len", "cnt", F.sum("cnt").over(w).alias("cum"),
                    F.sum("cnt").over(Window.partitionBy()).alias("total"))
    r1 = F.floor((F.col("total") + 1) / 2)
    r2 = F.floor(F.col("total") / 2) + 1
    return h.agg(
        F.sum("cnt").alias("n_titles"),
        (F.sum(F.col("len") * F.col("cnt")) / F.sum("cnt")).alias("mean_tokens"),
        F.max("len").alias("max_tokens"),
        F.min("len").alias("min_tokens"),
        ((F.min(F.when(F.col("cum") >= r1, F.col("len")))
          + F.min(F.when(F.col("cum") >= r2, F.col("len")))) / 2.0).alias("median_tokens"))
