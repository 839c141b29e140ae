import random
import re
from collections import Counter

import numpy as np
import pytest

from titleflow.llm import decontaminate as D


def brute_words(text):
    return [w for w in re.split("[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", (text or "").lower()) if w]


def brute_leaks(docs, items, similarity=0.8):
    """(doc, item) -> (similarity, first word) over all windows of the item's size."""
    out = {}
    for doc, text in docs:
        w = brute_words(text)
        for item, t in items:
            v = brute_words(t)
            k = min(5, len(v))
            if not v:
                continue
            grams = lambda x: Counter(tuple(x[i:i + k]) for i in range(len(x) - k + 1))  # noqa: E731, B023
            own = grams(v)
            for at in range(len(w) - len(v) + 1):
                there = grams(w[at:at + len(v)])
                common = sum((there & own).values())
                s = common / (sum(there.values()) + sum(own.values()) - common)
                if s >= similarity and s > out.get((doc, item), (0, 0))[0]:
                    out[doc, item] = (s, at)
    return out


def made(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(r.randint(2, 5)))
    items = [(i, " ".join(word() for _ in range(r.choice([15, 22, 40, 57, 80])))) for i in range(25)]
    items += [(90, "just three words"), (91, ""), (92, None), (93, " ".join(["again"] * 20))]
    docs = []
    for d in range(60):
        text = [word() for _ in range(r.randint(0, 120))]
        for _ in range(r.randint(0, 2)):
            leak = (r.choice(items)[1] or "").split()
            for _ in range(r.randint(0, 3)):
                if leak:
                    at = r.randrange(len(leak))
                    leak[at:at + 1] = r.choice([[word()], [], [leak[at].upper() + ","], [leak[at], word()]])
            at = r.randint(0, len(text))
            text[at:at] = leak
        docs.append((d, r.choice([" ", "  ", "\n", " - "]).join(text)))
    return [*docs, (100, None), (101, ""), (102, "again " * 500), (102, "again " * 500), (None, items[0][1])], items


def test_leaks_against_brute_force(spark):
    docs, items = made(4)
    rows = D.find_leaks(spark.createDataFrame(docs, "doc_id long, text string").withColumnRenamed("doc_id", "doc_id"),
                        spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): (r.similarity, r.first_word) for r in rows}
    want = brute_leaks(docs, items)
    assert len(want) > 20 and got.keys() == want.keys()
    for key, (s, at) in want.items():
        assert got[key][0] == pytest.approx(s) and got[key][1] == at
    assert sum(r.doc_id == 102 for r in rows) == 2  # repeated rows give rows of their own


@pytest.mark.parametrize("block_chars", [8 << 20, 300])
def test_clean_documents_stay(spark, block_chars):
    docs, items = made(6)
    table = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, item_id long, w string")
    items_table = spark.createDataFrame(items, "item_id long, text string")
    kept = D.keep_clean(table, items_table, block_chars=block_chars)
    assert kept.columns == table.columns
    leaky = {d for d, _ in brute_leaks(docs, items)}
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted((d for d, _ in docs if d not in leaky), key=str)
    assert D.keep_clean(table, items_table.limit(0)).count() == len(docs)
    assert D.find_leaks(table.limit(0), items_table).count() == 0


def test_multi_index_is_complete():
    r = np.random.default_rng(1)
    items = r.integers(0, 2**64, 300, np.uint64)
    windows = items[r.integers(0, 300, 2000)]
    for _ in range(24):
        windows = windows ^ (np.uint64(1) << r.integers(0, 64, 2000, np.uint64))
    w, i = D.MultiIndex(items, D.RADIUS).within(windows)
    near = np.bitwise_count(windows[:, None] ^ items[None, :]) <= D.RADIUS
    assert set(zip(w.tolist(), i.tolist(), strict=True)) == set(zip(*(x.tolist() for x in np.nonzero(near)), strict=True))


def test_very_long_document():
    item = " ".join(f"q{i}" for i in range(40))
    text = " ".join(f"w{i % 997}" for i in range(60_000)) + " " + item
    index = D.Benchmark([(7, item.encode())], 5, 0.8)
    assert index.find(text.encode()) == [(7, 1.0, 60_000, 40)]


@pytest.mark.parametrize("size", [100, 200, 400, 1000])
@pytest.mark.parametrize("end", ["refrain", "words", "other"])
def test_repetitive_items_are_found(size, end):
    r = random.Random(size)
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(6))
    missed = 0
    for _ in range(6):
        tail = size // 9
        body = [word() for _ in range(size - tail)]
        item = body + (["again"] * tail if end != "other" else [word() for _ in range(tail)])
        new = ["often"] * tail if end != "words" else [word() for _ in range(tail)]
        keep = next(n for n in range(tail) if brute_similar(item, body + item[size - tail:size - tail + n] + new[n:]) >= 0.8)
        window = body + item[size - tail:size - tail + keep] + new[keep:]
        found = D.Benchmark([(1, " ".join(item).encode())], 5, 0.8).find(" ".join(["x", "y", *window, "z"]).encode())
        missed += not found
    assert not missed


def brute_similar(a, b):
    grams = lambda x: Counter(tuple(x[i:i + 5]) for i in range(len(x) - 4))
    common = sum((grams(a) & grams(b)).values())
    return common / (len(a) + len(b) - 8 - common)
