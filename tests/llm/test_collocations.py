import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from titleflow.llm import collocations as C
from titleflow.llm.queries import op12_collocations


def brute(rows, least, longest=5, top=2000):
    """Counts of every gram of every size, in Python integers."""
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", fold):
            w = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(w)
            f = counts.setdefault(lang, Counter())
            for k in range(1, longest + 1):
                f.update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        some = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rest = []
        for p, a in some.items():
            inside = any(len(q) > len(p) and b >= a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                         for q, b in some.items())
            if inside:
                continue
            n = total[lang]
            s, _, l, r = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            rest.append((-s, -a, " ".join(p).encode(), l, r, n))
        for rank, (s, a, p, l, r, n) in enumerate(sorted(rest)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, n, -s))
    return sorted(out)


def made(seed, n=300):
    r = random.Random(seed)
    few = ["Alpha", "beta", "GAMMA", "delta", "é", "Ähre", "日本", "x-y", "1,5", "a b"]
    fixed = ["new york city", "once upon a time there", "in the", "of the of the"]
    gap = [" ", "  ", "\t", " \t ", ". ", ", ", "\n", "\r\n", " ;", ":", "!", "?\x0b", "\x0c"]
    rows = []
    for _ in range(n):
        parts = [r.choice(fixed) if r.random() < 0.3 else r.choice(few) for _ in range(r.randint(0, 40))]
        rows.append((r.choice(["en", "de", None]), "".join(x for p in parts for x in (p, r.choice(gap) if r.random() < 0.4 else " "))))
    return [*rows, ("en", None), (None, ""), ("fr", " . ,\n"), ("fr", "one"), ("en", rows[0][1]), ("en", rows[0][1])]


@pytest.mark.parametrize("block", [1, 64, 1 << 20])
def test_words_of_blocks_of_any_size(monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK_BYTES", block)
    rows = [("und" if a is None else a, b or "") for a, b in made(1)]
    batch = C.pa.RecordBatch.from_arrays([C.pa.array([r[0] for r in rows]), C.pa.array([r[1] for r in rows])], ["lang", "text"])
    got, want = [], []
    for w in C._blocks(iter([batch])):
        texts = w.grams(np.arange(len(w.start)), np.arange(len(w.start))).to_pylist()
        got += [(w.names[c], t, bool(j)) for c, t, j in zip(w.lang, texts, w.joined, strict=True)]
    for lang, text in rows:
        fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        for piece in re.split("[.,;:!?\x0a-\x0d]", fold):
            cut = re.findall("[^\x20\x09]+", piece)
            want += [(lang, t, i + 1 < len(cut)) for i, t in enumerate(cut)]
    assert got == want


@pytest.mark.parametrize("least,top", [(3, 2000), (12, 5), (5, 2000)])
def test_equals_brute_force(spark, least, top):
    rows = made(least)
    docs = spark.createDataFrame([(i, *r, "x") for i, r in enumerate(rows)], "n long, lang string, text string, phrase string")
    got = sorted(tuple(r) for r in C.collocations(docs, least=least, top=top).collect())
    want = brute(rows, least, top=top)
    assert len(want) > 8 and got == want


def test_empty_tables_and_texts(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert C.collocations(empty).count() == 0
    assert C.collocations(spark.createDataFrame([(None, None), ("en", "")], "lang string, text string")).count() == 0


def test_a_crowded_sieve_changes_nothing(spark):
    rows = made(9)
    docs = spark.createDataFrame(rows, "lang string, text string")
    full = np.full((1 << C.SLOT_BITS) // 8, 255, np.uint8)
    rows = docs.selectExpr("coalesce(lang, 'und') AS lang", "coalesce(text, '') AS text")
    count = lambda *bitmaps: {(r.lang, r.gram): r.n for r in C.flow(C.edges(rows, [*bitmaps], 5), 5).collect()}
    pairs = C.sieve(rows, 7, [])
    everything, sieved = count(full, full), count(pairs, C.sieve(rows, 7, [pairs]))
    assert len(sieved) < len(everything)
    assert {k for k, n in everything.items() if n >= 7} == {k for k, n in sieved.items() if n >= 7}
    assert all(everything[k] == n for k, n in sieved.items() if n >= 7)


def test_scores_beyond_64_bits(spark):
    row = spark.sql("select 4000000000000 a, 9000000000000000 n, 5000000000000 l, 4000000000001 r")
    q = row.selectExpr("(cast(a as decimal(18,0)) * cast(n as decimal(16,0)) * cast(1000 as decimal(4,0)))"
                       " div (cast(l as decimal(19,0)) * cast(r as decimal(19,0))) AS s").first().s
    assert q == 1000 * 4000000000000 * 9000000000000000 // (5000000000000 * 4000000000001)


def test_query_equals_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = sorted(con.sql(f"SELECT {', '.join(cols)} FROM ({C.SQL})").fetchall())
    got = sorted(tuple(r) for r in op12_collocations(spark, sf).select(*cols).collect())
    assert len(want) > 20 and got == want
