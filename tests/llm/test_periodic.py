import hashlib
import zlib

import numpy as np
import pytest

from titleflow.llm import periodic as P
from titleflow.llm.queries import op13_periodic_runs


def brute_runs(words, least=12):
    """Runs by comparing every word with the word q later, for every q."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            digest("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()),
            digest(b" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("points", [2, 4, 64, 1024])
def test_transform_gives_exact_products(points):
    r = np.random.default_rng(points)
    a, b = (r.integers(0, P.PRIME, (3, points // 2)) for _ in range(2))
    pad = lambda x: np.concatenate([x, np.zeros_like(x)], 1).astype(np.float64)
    got = P.backward(P._mod(P.forward(pad(a)) * P.forward(pad(b)))).astype(np.int64) % P.PRIME
    for row, x, y in zip(got, a, b, strict=True):
        want = [0] * points
        for i, u in enumerate(x.tolist()):
            for j, v in enumerate(y.tolist()):
                want[i + j] = (want[i + j] + u * v * points) % P.PRIME
        assert row.tolist() == want


def sequences():
    r = np.random.default_rng(5)
    out = [np.array([], np.int64), np.array([3]), np.zeros(11, np.int64), np.zeros(12, np.int64), np.zeros(300, np.int64)]
    out += [r.integers(0, k, n) for k in (2, 3, 4) for n in (30, 100, 257)]
    for q in (1, 2, 3, 5, 6, 7, 14, 15, 31, 64, 100):  # a run inside other words, and one of exactly two periods
        out.append(np.concatenate([100 + r.integers(0, 50, 9), np.tile(r.integers(0, 30, q), 5)[:4 * q + 3], [7, 8]]))
        out.append(np.concatenate([100 + r.integers(0, 50, 4), np.tile(np.arange(q), 2), [200]]))
    word = [0]
    for _ in range(8):
        word = word + [1 - x for x in word]  # no overlaps at all
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 400:
        fib.append(fib[-1] + fib[-2])  # as many runs as a text can nearly have
    return [*out, np.array(word), np.array(fib[-1]), np.concatenate([np.tile(np.tile(np.arange(4), 5).tolist() + [9], 6), [9, 9]])]


def test_runs_equal_brute_force():
    texts = sequences()
    for got, t in zip(P.find_runs(texts), texts, strict=True):
        assert [tuple(x) for x in got.tolist()] == brute_runs(t.tolist())
    for t in texts:  # alone, and with blocks cut short
        assert [tuple(x) for x in P.find_runs([t])[0].tolist()] == brute_runs(t.tolist())


def test_runs_with_short_blocks(monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 4)
    monkeypatch.setattr(P, "SLICE", 64)
    texts = sequences()
    for got, t in zip(P.find_runs(texts), texts, strict=True):
        assert [tuple(x) for x in got.tolist()] == brute_runs(t.tolist())


def test_a_hash_that_goes_too_far_is_corrected(monkeypatch):
    real = P._agreeing
    monkeypatch.setattr(P, "_agreeing", lambda ids, longest: lambda i, j: np.minimum(real(ids, longest)(i, j) + 1, len(ids) - j))
    texts = [t for t in sequences() if len(t) < 120]
    for t in texts:
        want = brute_runs(t.tolist())
        assert [tuple(x) for x in P.find_runs([t])[0].tolist()] == want


def test_documents_with_nulls_ties_and_extra_columns(spark):
    line = "all work and no play makes dull text "
    rows = [(1, line * 40, "x"), (1, line * 40, "x"), (2, None, None), (3, "", "x"), (4, " \t\n ", "x"), (None, "a b " * 9, "x"),
            (5, "na " * 11, "x"), (6, "na\tna\n" * 6, "x"), (7, " x " * 12, "x")]
    rows += [(i, " ".join(f"w{(i * j * j) % 97}" for j in range(i)), "x") for i in range(10, 120)]
    rows += [(500, " ".join(f"w{j % 1500}" for j in range(20000)), None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    got = P.run_digest(P.periodic_runs(docs.withColumn("text", P.planted(docs.doc_id, docs.text)))).collect()
    want = [brute_row(i, t) for i, t, _ in rows if i != 500]
    assert sorted((tuple(r) for r in got if r.doc_id != 500), key=str) == sorted(want, key=str)
    long = next(r for r in got if r.doc_id == 500)
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 20000, 1500) or zlib.crc32(b"500") % 10 == 0
    assert P.run_digest(P.periodic_runs(docs.limit(0))).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, sf).collect()}
    assert got.keys() == docs.keys()
    short = [i for i, t in docs.items() if len((t or "").split()) < 1500]
    assert len(short) > 100
    for i in short:
        assert got[i] == brute_row(i, docs[i])
