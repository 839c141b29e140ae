"""Chat formatting with cumulative-snapshot collapse.

Chat loggers often store a conversation again after every turn, each time
with one turn more. Every conversation gets rolling hashes of its turn
prefixes; a conversation whose full hash is a proper prefix of a longer one
is dropped by an anti-join, of equal conversations the smallest id stays.
The maximal ones are rendered.

A prefix hash is the xor over its turns of a hash of (place, role, text):
two independent 64-bit words. Xor is associative, so prefixes are computed
in two levels: inside chunks of ``CHUNK`` consecutive turns, and over the
chunks' totals. No task needs a whole conversation together, however many
turns one id has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from titleflow.llm.common import stored

CHUNK = 1024
#: Template of a rendered turn; role and text are put in by :func:`escaped`.
TURN = ("<|", "|>\n", "\n<|end|>\n")


def escaped(words: Column) -> Column:
    """A text that holds no mark of the template: every ``<|`` gets a
    backslash between its two characters, and every run of backslashes
    there one more, so that taking one away gives the text back."""
    return F.regexp_replace(words, r"<(\\*)\|", r"<\\$1|")


def _ordered(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(conv, place, role, text): distinct turns in order, place from 0.

    The order is (turn, role, text), nulls first. Turn numbers are dealt
    into chunks; a turn's place is its chunk's offset plus its place inside
    the chunk, so only counts meet in one task. Null turn numbers are one
    chunk before all others. Conversations with a null id are one
    conversation of that id.
    """
    rows = turns.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"),
                        F.col(role).alias("role"), F.col(text).alias("text")).distinct()
    rows = rows.withColumn("chunk", F.floor(F.col("turn") / CHUNK).cast("long"))
    inside = Window.partitionBy("conv", "chunk").orderBy("turn", "role", "text")
    rows = rows.withColumn("rank", F.row_number().over(inside))
    sizes = rows.groupBy("conv", "chunk").agg(F.count(F.lit(1)).alias("n"))
    over = Window.partitionBy("conv").orderBy(F.col("chunk").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    offsets = sizes.select("conv", "chunk", (F.sum("n").over(over) - F.col("n")).alias("offset"))
    o = offsets.select(F.col("conv").alias("oc"), F.col("chunk").alias("ok"), "offset")
    at = rows.join(o, rows.conv.eqNullSafe(o.oc) & rows.chunk.eqNullSafe(o.ok))
    return at.select("conv", (F.col("offset") + F.col("rank") - 1).alias("place"), "role", "text")


def _hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "place", F.isnull("role"), "role", F.isnull("text"), "text")


def prefixes(ordered: DataFrame) -> DataFrame:
    """(conv, n, p1, p2, total): the hashes of the first n turns, per turn,
    and the conversation's number of turns."""
    h = ordered.select("conv", "place", F.floor(F.col("place") / CHUNK).alias("chunk"),
                       _hash(1).alias("h1"), _hash(2).alias("h2"))
    up = [Window.unboundedPreceding, Window.currentRow]
    inside = Window.partitionBy("conv", "chunk").orderBy("place").rowsBetween(*up)
    h = h.select("conv", "chunk", "place", F.bit_xor("h1").over(inside).alias("i1"),
                 F.bit_xor("h2").over(inside).alias("i2"))
    chunks = ordered.groupBy("conv", F.floor(F.col("place") / CHUNK).alias("chunk")).agg(
        F.bit_xor(_hash(1)).alias("c1"), F.bit_xor(_hash(2)).alias("c2"), F.count(F.lit(1)).alias("cn"))
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    chunks = chunks.select(F.col("conv").alias("oc"), F.col("chunk").alias("ok"),
                           F.coalesce(F.bit_xor("c1").over(before), zero).alias("b1"),
                           F.coalesce(F.bit_xor("c2").over(before), zero).alias("b2"),
                           F.sum("cn").over(Window.partitionBy("conv")).alias("total"))
    at = h.join(chunks, h.conv.eqNullSafe(chunks.oc) & h.chunk.eqNullSafe(chunks.ok))
    return at.select("conv", (F.col("place") + 1).alias("n"), F.col("i1").bitwiseXOR(F.col("b1")).alias("p1"),
                     F.col("i2").bitwiseXOR(F.col("b2")).alias("p2"), "total")


def maximal(ordered: DataFrame) -> DataFrame:
    """(conv, n): the conversations that no longer one extends, of equal
    ones that with the smallest id (a null id only if it is alone)."""
    p = stored(prefixes(ordered))
    whole = p.where("n = total").groupBy("n", "p1", "p2").agg(F.min("conv").alias("conv"))
    # a first turn that a third of all conversations share is one row here
    inner = p.where("n < total").select("n", "p1", "p2").distinct()
    return whole.join(inner, ["n", "p1", "p2"], "left_anti").select("conv", "n")


def format_turns(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                 text: str = "text") -> DataFrame:
    """One row per turn of the maximal conversations: conv, place, n_turns,
    rendered. A conversation's training text is its rows in place order;
    marks of the template inside a role or text are escaped, so no text can
    end its turn or begin another.

    Wholly equal turn rows count once; turns with equal numbers stay in
    (role, text) order; null roles render as ``unknown``, null texts as
    empty; an id that is null is one conversation; other columns are
    ignored; no turns: no rows.
    """
    rows = stored(_ordered(turns, conv, turn, role, text))
    kept = maximal(rows).select(F.col("conv").alias("kc"), F.col("n").alias("n_turns"))
    out = rows.join(kept, rows.conv.eqNullSafe(kept.kc))
    a, b, c = map(F.lit, TURN)
    body = F.concat(a, F.coalesce(escaped(F.col("role")), F.lit("unknown")), b,
                    F.coalesce(escaped(F.col("text")), F.lit("")), c)
    return out.select(F.col("conv").alias(conv), "place", "n_turns", body.alias("rendered"))


def snapshots(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
              text: str = "text") -> DataFrame:
    """One row per conversation: id, n_turns, kept.

    Null ids are one conversation, null turn numbers come first, wholly
    equal turn rows count once, ties stay in (role, text) order; no turns:
    no rows; other columns are ignored.
    """
    rows = stored(_ordered(turns, conv, turn, role, text))
    all_of = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n_turns"))
    kept = maximal(rows).select(F.col("conv").alias("kc"), F.lit(True).alias("kept"))
    out = all_of.join(kept, all_of.conv.eqNullSafe(kept.kc), "left")
    return out.select(F.col("conv").alias(conv), "n_turns", F.coalesce("kept", F.lit(False)).alias("kept"))
