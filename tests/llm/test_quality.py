import random
import re
from collections import Counter

from titleflow.llm import quality as Q


def brute(text):
    t = text or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", t) if x]
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    inside = {i + k for i in range(len(w) - 2) if grams[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", t)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside), "n_lines": len(lines),
            "n_letter_words": sum(bool(re.search("[A-Za-z]|[^\x00-\x7f]", x)) for x in w),
            "n_capital_runs": len(re.findall("[A-Z]{2,}", t))}


def brute_bits(m):
    fails = [m["n_words"] < 50, 100 * m["n_repeat_words"] > 50 * m["n_words"],
             not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"], 10 * m["n_symbols"] > m["n_words"],
             100 * m["n_dup_lines"] > 60 * m["n_lines"], 100 * m["n_letter_words"] < 70 * m["n_words"],
             100 * m["n_capital_runs"] > 50 * m["n_words"]]
    return sum(1 << i for i, f in enumerate(fails) if f)


def made():
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 9)))
    plain = [" ".join(word() for _ in range(n)) for n in (0, 1, 2, 3, 49, 50, 51, 200)]
    odd = [None, "", " \t\r\n\x0b\x0c ", "a b c a b c", "x x x x", "same line\nsame line\n\n  \nsame line",
           " ".join(["SHOUT!!"] * 60), "# $ % " * 40, "1 2 3 " * 40, "word " * 300, "a b c", "y" * 3000,
           "\n".join(["one two three"] * 30), " ".join(word() for _ in range(60)) + " ###" * 6]
    return plain + odd + [" ".join(r.choice(["un", "deux", "trois", "quatre", "cinq"]) for _ in range(n))
                          for n in (5, 20, 80, 400)]


def test_ledger_against_brute_force(spark):
    texts = made()
    rows = [(i, t, "x", 1, 7) for i, t in enumerate(texts)] + [(900, "a b", None, None, None)] * 2 + [(None, "q", "", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string, failed_bits int, w int")
    out = Q.judge(Q.ledger(docs)).collect()
    assert len(out) == len(rows)
    by_id = {r.doc_id: r for r in out}
    for doc, text, *_ in rows:
        want, got = brute(text), by_id[doc]
        assert {k: got[k] for k in want} == want, text
        bits = brute_bits(want)
        assert got.failed_bits == bits and got.base_failed == bool(bits & 3) and got.kept == (bits == 0)
    kept = Q.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, r in by_id.items() if r.kept)
    assert Q.ledger(docs.limit(0)).count() == 0 and Q.keep_good(docs.limit(0)).count() == 0


def test_policies_and_ablation_are_bit_arithmetic(spark):
    bits = [0, 0, 1, 2, 3, 8, 9, 64, 72, 16]
    rows = spark.createDataFrame([(i, b) for i, b in enumerate(bits)], "doc_id long, failed_bits long")
    assert [r.kept for r in Q.judge(rows, "base").orderBy("doc_id").collect()] == [not b & 3 for b in bits]
    no_caps = [r.kept for r in Q.judge(rows, "v1-no-capitals").orderBy("doc_id").collect()]
    assert no_caps == [b in (0, 64) for b in bits]
    got = {r.bit: (r.n_failed, r.n_only, r.n_kept_without) for r in Q.ablation(rows).collect()}
    for rule in Q.RULES:
        own = 1 << rule.bit
        assert got[rule.bit] == (sum(bool(b & own) for b in bits), bits.count(own), sum(not b & ~own for b in bits))


def test_very_long_text(spark):
    text = " ".join(f"w{i}" for i in range(50_000)) + " w1 w2 w3 w4"
    r = Q.ledger(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (r.n_words, r.n_repeat_words) == (50_004, 8)
