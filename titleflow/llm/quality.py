"""Quality rules as a bitmask ledger (native expressions only).

:func:`ledger` measures every document once and evaluates every rule once:
one row per document with the measurements and a long ``failed_bits`` in
which bit ``k`` says that rule ``k`` failed. Policies are versioned masks
over the same ledger (:data:`POLICIES`), so a new policy or an ablation
(:func:`ablation`) is bit arithmetic over stored rows and never reads the
texts again. No shuffle: all measurements are taken inside the row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleflow.llm.common import let, total, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_letter_words", "n_capital_runs")


@dataclass(frozen=True)
class Rule:
    """``fails`` is an SQL condition over :data:`MEASURES`, in integers, that
    other engines read alike. The bit is the rule's place for ever."""
    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule(3, "symbols", "10 * n_symbols > n_words"),
    Rule(4, "duplicate_lines", "100 * n_dup_lines > 60 * n_lines"),
    Rule(5, "letterless_words", "100 * n_letter_words < 70 * n_words"),
    Rule(6, "capitals", "100 * n_capital_runs > 50 * n_words"),
)
BASE_BITS = 0b11
#: Policy version -> bits whose failure rejects a document.
POLICIES = {"base": BASE_BITS, "v1": 0b1111111, "v1-no-capitals": 0b0111111}


def repeated_words(w: Column) -> Column:
    """Words inside 3-word windows found twice or more in the text.

    Windows are compared by a 64-bit hash of their three words. Sorted
    (hash, place) pairs bring equal windows together; the union of the
    repeated windows is summed from their sorted places. Texts without a
    repeated window (one hash set) skip the sort.
    """
    def covered(at: Column) -> Column:
        gaps = F.transform(at, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(at, k + 1) - x, F.lit(3))))
        return total(gaps)

    def twice(s: Column) -> Column:
        same = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
                        | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)))
        return let(F.sort_array(F.transform(same, lambda x: x["i"])), covered)

    def of_hashes(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(let(pairs, twice))

    def of_words(v: Column) -> Column:
        window = F.transform(F.sequence(F.lit(0), F.size(v) - 3),
                             lambda i: F.xxhash64(F.get(v, i), F.get(v, i + 1), F.get(v, i + 2)))
        return F.when(F.size(v) < 4, F.lit(0).cast("long")).otherwise(let(window, of_hashes))

    return of_words(w)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with a struct column ``__m`` of all :data:`MEASURES` (longs)."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def of(w: Column) -> Column:
        return let(lines, lambda ls: F.struct(
            F.size(w).cast("long").alias("n_words"),
            total(F.transform(w, F.char_length)).alias("word_chars"),
            F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
            repeated_words(w).alias("n_repeat_words"),
            F.size(ls).cast("long").alias("n_lines"),
            F.size(F.filter(w, lambda x: x.rlike(r"[A-Za-z\x{80}-\x{10FFFF}]"))).cast("long").alias("n_letter_words"),
            F.regexp_count(t, F.lit("[A-Z]{2,}")).cast("long").alias("n_capital_runs")))

    return docs.withColumn("__m", let(words(F.col(text)), of))


def failed_bits() -> Column:
    """All rules over the measurement columns as one long."""
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit)).otherwise(F.lit(0)).cast("long"))
    return bits


def ledger(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id, :data:`MEASURES`, ``failed_bits``.

    Null and empty texts measure 0 everywhere (and so fail ``few_words``);
    repeated rows and null ids give a row each; other columns are ignored.
    """
    m = measured(docs.select(id_col, text), text)
    flat = m.select(id_col, *[F.col(f"__m.{c}").alias(c) for c in MEASURES])
    return flat.withColumn("failed_bits", failed_bits())


def judge(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Add ``base_failed`` and ``kept`` (base passed and no bit of the
    policy failed) to ledger rows."""
    bits = F.col("failed_bits")
    base = bits.bitwiseAND(F.lit(BASE_BITS).cast("long")) != 0
    bad = bits.bitwiseAND(F.lit(POLICIES[policy]).cast("long")) != 0
    return rows.withColumn("base_failed", base).withColumn("kept", ~base & ~bad)


def ablation(rows: DataFrame, policy: str = "v1") -> DataFrame:
    """Per rule of the policy: ``n_failed`` documents, ``n_only`` rejected by
    this rule alone, and ``n_kept_without`` it, from bit arithmetic. The
    ledger is first counted per distinct bit pattern (a map-side combined
    aggregate of at most 2^rules rows)."""
    mask = POLICIES[policy]
    seen = rows.groupBy(F.col("failed_bits").bitwiseAND(F.lit(mask).cast("long")).alias("b")).agg(
        F.count(F.lit(1)).alias("n"))
    rules = [r for r in RULES if mask >> r.bit & 1]
    each = F.explode(F.array(*[F.struct(F.lit(r.bit).alias("bit"), F.lit(r.name).alias("rule")) for r in rules]))
    r = seen.select("b", "n", each.alias("r")).withColumn("own", F.expr("shiftleft(1L, r.bit)"))
    n_if = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    rest = F.col("b").bitwiseAND(F.bitwise_not(F.col("own")))
    return r.groupBy(F.col("r.bit").alias("bit"), F.col("r.rule").alias("rule")).agg(
        n_if(F.col("b").bitwiseAND(F.col("own")) != 0).alias("n_failed"),
        n_if((F.col("b") == F.col("own"))).alias("n_only"),
        n_if(rest == 0).alias("n_kept_without"))


def keep_good(docs: DataFrame, policy: str = "v1", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the policy keeps, columns unchanged."""
    m = measured(docs, text).where(
        F.expr("NOT (" + " OR ".join(f"({_on_struct(r.fails)})" for r in RULES
                                     if (POLICIES[policy] | BASE_BITS) >> r.bit & 1) + ")"))
    return m.select(*[F.col(f"`{c}`") for c in docs.columns])


def _on_struct(condition: str) -> str:
    for name in MEASURES:
        condition = condition.replace(name, f"__m.{name}")
    return condition
