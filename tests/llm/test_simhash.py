import numpy as np
import pytest
import xxhash

from titleflow.llm import simhash as S
from titleflow.llm.components import components


def brute_roots(fps, radius):
    """Smallest place reachable over links, by repeated relaxing."""
    label = list(range(len(fps)))
    near = [[j for j in range(len(fps)) if bin(fps[i] ^ fps[j]).count("1") <= radius] for i in range(len(fps))]
    changed = True
    while changed:
        changed = False
        for i, js in enumerate(near):
            m = min(label[j] for j in js)
            if m < label[i]:
                label[i], changed = m, True
    return label


def brute_fingerprint(text, k=4):
    fold = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", fold) if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("text", ["", " \t\n", "one", "Two WORDS here", "ÄÖ É x y z x y z x y z",
                                  "a b c d e f g", "the same four words " * 50, "x" * 5000])
def test_fingerprint(text):
    assert S.fingerprint(text.encode()) == brute_fingerprint(text)


def random_words(seed, n=300, near=200):
    r = np.random.default_rng(seed)
    base = r.integers(0, 2**64, n, np.uint64)
    copies = base[r.integers(0, 20, near)]
    for _ in range(5):
        copies = copies ^ (np.uint64(1) << r.integers(0, 64, near, np.uint64))
    return np.unique(np.concatenate([base, copies, [np.uint64(0), np.uint64(3), np.uint64(2**64 - 1)]]))


def gray_sorted(words):
    rank = words.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return words[np.argsort(rank)]


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_index_finds_exactly_the_pairs_within_the_radius(radius):
    words = gray_sorted(random_words(7))
    q, hit = S.GrayIndex(words).within(words, radius)
    want = {(i, j) for i in range(len(words)) for j in range(len(words))
            if int(words[i] ^ words[j]).bit_count() <= radius}
    assert len(q) == len(want) and set(zip(q.tolist(), hit.tolist(), strict=True)) == want


@pytest.mark.parametrize("n", [0, 1, 2, 8, 9, 64, 65])
def test_index_of_any_size(n):
    words = gray_sorted(random_words(n)[:n])
    q, hit = S.GrayIndex(words).within(words, 4) if n else ([], [])
    assert {i for i, j in zip(q, hit, strict=True) if i == j} == set(range(n))


@pytest.mark.parametrize("bucket_rows", [20_000, 3])
def test_components_of_fingerprints(spark, bucket_rows):
    words = random_words(11)
    fps = words.view(np.int64).tolist()
    rows = spark.createDataFrame([(i, f) for i, f in enumerate(fps)], "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in S.near_duplicates(rows, bucket_rows=bucket_rows).collect()}
    want = brute_roots([int(w) for w in words], 4)
    assert got == dict(enumerate(want))


def test_documents_with_nulls_ties_and_extra_columns(spark):
    long_text = " ".join(f"word{i}" for i in range(400))
    rows = [(5, long_text, "x", 1), (3, long_text + " tail", "x", 1), (9, None, None, None), (8, "", "x", 1),
            (7, "other words entirely here", "x", 1), (7, "other words entirely here", "x", 1), (None, long_text, "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, root long")
    got = sorted(((r.doc_id, r.component_id) for r in S.simhash_components(docs).collect()), key=str)
    assert got == sorted([(5, 3), (3, 3), (9, 8), (8, 8), (7, 7), (7, 7), (None, 3)], key=str)
    kept = S.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 7, 8]
    assert S.simhash_components(docs.limit(0)).count() == 0 and S.keep_one(docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame([*chain, *star, (5, 5), (None, 3), (2000, 2001), (2000, 2001)], "a long, b long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 200)} | {2001: 2000}
    assert components(edges.limit(0)).count() == 0
