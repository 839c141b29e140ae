"""Sub-word encoding by greedy longest match.

A word is cut from the left: the longest vocabulary piece that the rest of
the word begins with, then the next one; pieces inside a word stand in the
vocabulary with a mark (``##``). A word with a place where no piece fits,
or of more than ``max_chars`` characters, is one unknown token.

Words are cut once each, however often they occur: all their substrings
that can be a piece meet the vocabulary in one join, the longest match per
(word, place) is a partial + final aggregate, and the cuts are then read
off per word. No loop over rounds, no vocabulary on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.functions.arrays import fit_length
from titleflow.operators.joins import lookup_join
from titleflow.operators.text import _POS, _TOK, _explode_tokens, _regroup, _with_row
from titleflow.session import cut_lineage


def word_pieces(words: DataFrame, vocab: DataFrame, *, word: str = "word", unk_id: int = 3, mark: str = "##",
                max_chars: int = 100) -> DataFrame:
    """(word, pieces, ids) of every distinct word of ``words``.

    ``vocab`` is a table (token, id); of a repeated token the smallest id
    counts, NULL tokens and ids are ignored. The empty word and NULL have no row.
    """
    distinct = words.select(F.col(word).alias("word")).where("word is not null and word <> ''").distinct()
    pieces = vocab.where("token is not null and id is not null").groupBy("token").agg(F.min("id").cast("int").alias("id"))
    pieces = cut_lineage(pieces)
    longest = pieces.agg(F.max(F.char_length("token"))).first()[0] or 0
    distinct = cut_lineage(distinct)
    short = distinct.where(F.char_length("word") <= max_chars)
    at = short.select("word", F.explode(F.sequence(F.lit(1), F.char_length("word"))).alias("at"))
    cut = at.select("word", "at", F.explode(F.expr(f"sequence(1, least({max(longest, 1)}, char_length(word) - at + 1))")).alias("n"))
    cut = cut.select("word", "at", "n", F.expr(
        "case when at = 1 then '' else '" + mark.replace("'", "''") + "' end || substring(word, at, n)").alias("token"))
    hits = lookup_join(cut, pieces, "token", how="inner", salt_by=["word", "at", "n"])
    best = hits.groupBy("word", "at").agg(F.max(F.struct("n", "id", "token")).alias("x"))
    places = best.groupBy("word").agg(F.map_from_entries(F.collect_list(F.struct("at", "x"))).alias("m"))
    # from every place on the way the longest piece; a place without one ends it at 0
    walk = F.expr("""aggregate(sequence(1, char_length(word)),
        named_struct('at', 1, 'ids', cast(array() as array<int>), 'pieces', cast(array() as array<string>)),
        (s, i) -> case when s.at <> i then s when m[i] is null then named_struct('at', 0, 'ids', s.ids, 'pieces', s.pieces)
                  else named_struct('at', i + m[i].n, 'ids', array_append(s.ids, m[i].id),
                                    'pieces', array_append(s.pieces, m[i].token)) end)""")
    done = places.select("word", walk.alias("s"), F.char_length("word").alias("n")).where("s.at = n + 1").select(
        "word", "s.ids", "s.pieces")
    return distinct.join(done, "word", "left").select(
        "word", F.coalesce("pieces", F.array(F.lit(None).cast("string"))).alias("pieces"),
        F.coalesce("ids", F.array(F.lit(unk_id))).alias("ids"))


def encode_pieces(df: DataFrame, tokens: str, vocab: DataFrame, *, key: str = "Id", max_len: int = 64,
                  start_id: int | None = 1, end_id: int | None = 2, pad_id: int = 0, unk_id: int = 3,
                  mark: str = "##", max_chars: int = 100) -> DataFrame:
    """Title words -> fixed-length sub-word ``input_ids``, ``attention_mask``
    and ``n_tokens`` (real length with the specials), one row per title.

    A title's words are cut to the number that can fit before anything is
    looked up (a word has at least one piece). NULL and empty lists of words
    give the specials only; NULL and empty words no piece; repeated and NULL
    keys keep their rows. Other columns do not come along.
    """
    n_spec = int(start_id is not None) + int(end_id is not None)
    if max_len < n_spec:
        raise ValueError("max_len too small for the special ids")
    room = max_len - n_spec
    trunc = df.select(key, F.slice(F.filter(F.coalesce(F.col(tokens), F.array().cast("array<string>")),
                                            lambda w: w.isNotNull() & (w != "")), 1, room).alias("__tf_words"))
    # written once: the distinct words, the hot keys and the join read at most ``room`` words a
    # title instead of tokenising the texts again
    ex = _explode_tokens(_with_row(cut_lineage(trunc)), key, F.col("__tf_words"))
    table = word_pieces(ex.select(F.col(_TOK).alias("word")), vocab, unk_id=unk_id, mark=mark, max_chars=max_chars)
    table = cut_lineage(table.select(F.col("word").alias(_TOK), F.col("ids").alias("__tf_ids")))
    joined = lookup_join(ex, table, _TOK, how="left", salt_by=[key, _POS])
    reg = _regroup(joined, key, F.coalesce("__tf_ids", F.array().cast("array<int>")), "__tf_all")
    body = F.slice(F.flatten("__tf_all"), 1, room)
    if start_id is not None:
        body = F.concat(F.array(F.lit(start_id)), body)
    if end_id is not None:
        body = F.concat(body, F.array(F.lit(end_id)))
    reg = reg.select(key, body.alias("__tf_body"))
    return reg.select(key, fit_length("__tf_body", max_len, pad_id).alias("input_ids"),
                      F.transform(F.sequence(F.lit(1), F.lit(max_len)),
                                  lambda i: F.when(i <= F.size("__tf_body"), 1).otherwise(0)).alias("attention_mask"),
                      F.size("__tf_body").alias("n_tokens"))
