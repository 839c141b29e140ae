import random
import zlib

import pytest

from pyspark.sql import functions as F

from titleflow.llm import toxicity as X


def made(n, seed=1):
    """Label 1 needs an insult together with a group: neither alone."""
    r = random.Random(seed)
    filler = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    rows = []
    for i in range(n):
        words = [r.choice(filler) for _ in range(30)]
        insult, group = r.random() < 0.5, r.random() < 0.5
        words += ["IDIOT!"] * insult + ["them"] * group
        r.shuffle(words)
        rows.append((i, " ".join(words), int(insult and group)))
    return rows


def test_pairs_of_terms_are_learnt(spark):
    rows = made(900)
    docs = spark.createDataFrame([(i, t, "x", 0.1) for i, t, _ in rows], "doc_id long, text string, terms string, score double")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    out = {r.doc_id: r for r in X.toxicity(docs, labels, n_hash=1 << 12).collect()}
    assert len(out) == 900 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out.values())
    assert all(out[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in out)
    held = [(out[i].predicted, y) for i, _, y in rows if out[i].held_out]
    assert sum(p == y for p, y in held) >= 0.95 * len(held)


def test_held_out_labels_are_never_used(spark):
    rows = made(200, 2)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    a = X.training_rows(docs, labels, "doc_id", "text", "toxic", 10_000)
    flipped = labels.withColumn("toxic", F.when(X.held_out("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    b = X.training_rows(docs, flipped, "doc_id", "text", "toxic", 10_000)
    assert {(r.h, r.label) for r in a.collect()} == {(r.h, r.label) for r in b.collect()}
    assert a.count() == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(200))


def test_nulls_one_class_and_no_rows(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (None, "x"), (3, ""), (4, "w " * 100_000)], "doc_id long, text string")
    one = spark.createDataFrame([(4, 1), (4, None), (None, 1)], "doc_id long, toxic int")
    rows = X.toxicity(docs, one).collect()
    assert len(rows) == 5 and {r.held_out for r in rows if r.doc_id is None} == {False}
    assert len({r.score for r in rows}) == 1
    none = X.toxicity(docs, one.limit(0)).collect()
    assert [r.score for r in none] == [0.0] * 5 and {r.predicted for r in none} == {0}
    assert X.toxicity(docs.limit(0), one).count() == 0


def test_terms_that_tell_only_together(spark):
    """The label is whether both or neither of two terms stand in the text: neither tells anything alone."""
    import random
    r = random.Random(1)
    rows = []
    for i in range(1500):
        a, b = r.random() < 0.5, r.random() < 0.5
        words = [r.choice("pqrstuvwxyz") * 3 for _ in range(6)] + ["alpha"] * a + ["beta"] * b
        rows.append((i, " ".join(words), int(a == b)))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(x[0], x[2]) for x in rows], "doc_id long, toxic int")
    model = X.fit(docs, labels)
    truth = {i: y for i, _, y in rows}
    scored = X.score(docs, model).collect()
    held = [x for x in scored if x.held_out]
    assert sum(x.predicted == truth[x.doc_id] for x in held) / len(held) >= 0.9

    # the score, computed anew from the fitted weights
    import math
    hashing, select, machine = model.stages
    places = {old: new for new, old in enumerate(select.selectedFeatures)}
    w, v = machine.linear.toArray(), machine.factors.toArray()
    for x in scored[:40]:
        terms = sorted({t for t in rows[x.doc_id][1].split()})
        on = sorted({places[hashing.indexOf(t)] for t in terms if hashing.indexOf(t) in places})
        z = machine.intercept + sum(w[i] for i in on) + sum(
            float(v[i] @ v[j]) for k, i in enumerate(on) for j in on[k + 1:])
        assert x.score == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-9)
