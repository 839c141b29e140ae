import random

import pytest
from pyspark.sql import functions as F

from titleflow.operators import joins as J
from titleflow.operators import subword as W
from titleflow.operators import text as X


def brute(word, vocab, unk=3, mark="##", most=100):
    if len(word) > most:
        return [unk]
    at, out = 0, []
    while at < len(word):
        for n in range(len(word) - at, 0, -1):
            piece = ("" if at == 0 else mark) + word[at:at + n]
            if piece in vocab:
                out.append(vocab[piece])
                at += n
                break
        else:
            return [unk]
    return out


VOCAB = ["un", "##aff", "##able", "##a", "##f", "##ff", "aff", "a", "##b", "able", "##le", "##l", "##e", "日", "##本", "##😀", "😀", "##"]


def vocab_table(spark):
    rows = [(t, i + 10) for i, t in enumerate(VOCAB)]
    return spark.createDataFrame([*rows, ("un", 99), (None, 5), ("zz", None)], "token string, id int")


def test_pieces_equal_brute_force(spark):
    r = random.Random(2)
    words = ["unaffable", "unable", "affa", "", "x", "a" * 100, "a" * 101, "日本", "日本日", "😀😀", "unaffablex", "##able", "able##"]
    words += ["".join(r.choice("uafble") for _ in range(r.randint(1, 12))) for _ in range(400)]
    ids = {t: i + 10 for i, t in enumerate(VOCAB)}
    df = spark.createDataFrame([(w,) for w in [*words, *words[:5], None]], "word string")
    got = {x.word: x.ids for x in W.word_pieces(df, vocab_table(spark)).collect()}
    assert got == {w: brute(w, ids) for w in words if w}


@pytest.mark.parametrize("broadcast", [True, False])
def test_titles_with_nulls_repeats_and_long_words(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(J, "table_rows_at_most", lambda table, bound: False)
    rows = [(1, ["unaffable", "able"]), (1, ["able"]), (None, ["x", None, "", "able"]), (2, None), (3, []), (4, ["able"] * 30),
            (5, ["a" * 500])]
    df = spark.createDataFrame(rows, "Id long, t array<string>")
    got = sorted(((r.Id, r.input_ids, sum(r.attention_mask), r.n_tokens) for r in W.encode_pieces(
        df, "t", vocab_table(spark), max_len=8).collect()), key=str)
    ids = {t: i + 10 for i, t in enumerate(VOCAB)}
    want = []
    for i, words in rows:
        body = [1, *[x for w in words or [] if w for x in brute(w, ids)][:6], 2]
        want.append((i, (body + [0] * 8)[:8], len(body), len(body)))
    assert got == sorted(want, key=str)
    assert W.encode_pieces(df.limit(0), "t", vocab_table(spark)).count() == 0
    none = W.encode_pieces(df.where("Id = 4"), "t", vocab_table(spark).limit(0), max_len=8).first()
    assert none.input_ids == [1] + [3] * 6 + [2]


@pytest.fixture(params=["small", "large"])
def lookup(request, monkeypatch):
    """Both ways of a lookup: the whole table with the executors, and a join."""
    if request.param == "large":
        monkeypatch.setattr(X, "LOOKUP_ROWS", -1)
    return request.param


def test_repeated_keys_and_null_tokens_are_alike_on_both_ways(spark, lookup):
    df = spark.createDataFrame([(1, ["cats", "dogs", None]), (2, None), (3, [])], "Id long, t array<string>")
    lemmas = spark.createDataFrame([("cats", "kat"), ("cats", "cat"), ("dogs", "dog"), (None, "x")], "token string, lemma string")
    assert sorted((r.Id, r.t) for r in X.lemmatize(df, "t", lemmas).collect()) == [(1, ["cat", "dog", None]), (2, []), (3, [])]
    vocab = spark.createDataFrame([("cats", 9), ("cats", 7), ("dogs", 8)], "token string, id int")
    got = {r.Id: r.input_ids for r in X.encode(df, "t", vocab, max_len=6).collect()}
    assert got == {1: [1, 7, 8, 3, 2, 0], 2: [1, 2, 0, 0, 0, 0], 3: [1, 2, 0, 0, 0, 0]}
    vectors = spark.createDataFrame([("cats", [2.0]), ("cats", [1.0]), ("dogs", [3.0])], "token string, vector array<float>")
    got = {r.Id: (r.embedded, r.n_known) for r in X.embed_tokens(df, "t", vectors, 1, length=3).collect()}
    assert got == {1: ([[1.0], [3.0], [0.0]], 2), 2: ([[0.0]] * 3, 0), 3: ([[0.0]] * 3, 0)}
    for strategy in ("array", "join"):
        kept = X.remove_tokens(df, "t", ["dogs"], strategy=strategy)
        assert sorted((r.Id, r.t) for r in kept.collect()) == [(1, ["cats", None]), (2, []), (3, [])]


def test_irregular_forms_come_first(spark):
    from titleflow.operators.wordlists import IRREGULAR_NOUNS
    words = spark.createDataFrame([(w,) for w in ["women", "geese", "axes", "cats", "cat", "axe", "glasses", "glass", "gas"]], "t string")
    table = X.suffix_lemmas(words, words, exceptions=spark.createDataFrame(IRREGULAR_NOUNS, "token string, lemma string"))
    assert {r.token: r.lemma for r in table.collect()} == {"women": "woman", "geese": "goose", "axes": "axis", "cats": "cat",
                                                           "glasses": "glass"}


def test_naive_bayes_keeps_every_token(spark):
    from titleflow.operators import models as MD
    df = spark.createDataFrame([(f"word{i} common", i % 2) for i in range(300)], "Title string, Genre int")
    model = MD.fit_naive_bayes(df)
    assert len(model.pipeline.stages[0].vocabulary) == 301
    with pytest.raises(ValueError, match="301 distinct tokens"):
        MD.fit_naive_bayes(df, vocab_size=300)


def test_texts_are_tokenised_once(spark, monkeypatch):
    """The passes over the words (distinct ones, hot keys, join) read them from one written table."""
    from titleflow.operators import joins as J
    from titleflow.operators import subword as W
    from titleflow.operators import text as X
    monkeypatch.setattr(X, "LOOKUP_ROWS", 1)
    monkeypatch.setattr(W.lookup_join, "__kwdefaults__", {**J.lookup_join.__kwdefaults__, "max_broadcast_rows": 1})
    seen = spark.sparkContext.accumulator(0)

    def cut(t):
        seen.add(1)
        return t.split(" ")

    rows = [(i, "ab abc cab b") for i in range(40)]
    df = spark.createDataFrame(rows, "Id long, t string").select("Id", F.udf(cut, "array<string>").asNondeterministic()("t").alias("tokens"))
    vocab = spark.createDataFrame([("ab", 4), ("c", 5), ("##c", 6), ("##ab", 7), ("b", 8)], "token string, id int")
    for encode in (W.encode_pieces, X.encode):
        seen.value = 0
        got = encode(df, "tokens", vocab, max_len=8).collect()
        assert len(got) == 40 and seen.value == 40
