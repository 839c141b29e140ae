import statistics

import pytest
from pyspark.sql import functions as F

from titleflow.functions import tokenize_basic
from titleflow.operators import text as X


def test_encode_fixture(spark):
    vocab = spark.createDataFrame([("a", 4), ("test", 5)], "token string, id int")
    df = spark.createDataFrame([(0, ["a", "test"]), (1, ["a", "x", "test", "a", "x"]), (2, [])],
                               "Id long, tokens array<string>")
    got = {r.Id: r for r in X.encode(df, "tokens", vocab, max_len=6).collect()}
    assert got[0].input_ids == [1, 4, 5, 2, 0, 0] and got[0].attention_mask == [1, 1, 1, 1, 0, 0]
    assert got[1].input_ids == [1, 4, 3, 5, 4, 2] and got[1].attention_mask == [1] * 6
    assert got[2].input_ids == [1, 2, 0, 0, 0, 0] and got[2].attention_mask == [1, 1, 0, 0, 0, 0]
    # pad id equal to the end id: the mask still comes from the length
    got2 = {r.Id: r for r in X.encode(df, "tokens", vocab, max_len=6, pad_id=2).collect()}
    assert got2[0].input_ids == [1, 4, 5, 2, 2, 2] and got2[0].attention_mask == [1, 1, 1, 1, 0, 0]


def test_lookup_join_salted_equals_broadcast(spark):
    from titleflow.operators import joins
    vocab = spark.createDataFrame([("a", 4), ("test", 5), ("b", 6)], "token string, id int")
    # one hot token holding most rows
    df = spark.createDataFrame([(i, ["a"] * 5 + ["test", "b", "zz"][: i % 4]) for i in range(60)],
                               "Id long, tokens array<string>")
    ex = X._explode_tokens(df, "Id", F.col("tokens"))
    v = vocab.select(F.col("token").alias(X._TOK), F.col("id").alias("vid"))
    hot = joins.hot_keys(ex, X._TOK, sample_fraction=1.0, hot_share=0.3)
    assert [r[0] for r in hot.collect()] == ["a"]
    salted = joins.lookup_join(ex, v, X._TOK, max_broadcast_rows=0, salt_by=["Id", X._POS],
                               sample_fraction=1.0, hot_share=0.3, salt_buckets=4)
    bcast = joins.lookup_join(ex, v, X._TOK, max_broadcast_rows=10)
    plan = salted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    rows = sorted(map(tuple, salted.select("Id", X._POS, "vid").collect()))
    assert rows == sorted(map(tuple, bcast.select("Id", X._POS, "vid").collect()))
    assert len(rows) == sum(5 + len(["test", "b", "zz"][: i % 4]) for i in range(60))


def test_embed_tokens_fixture(spark):
    vec = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 4.0])], "token string, vector array<float>")
    df = spark.createDataFrame([(0, ["b", "zzz"])], "Id long, tokens array<string>")
    r = X.embed_tokens(df, "tokens", vec, 2, length=3).first()
    assert r.embedded == [[3.0, 4.0], [0.0, 0.0], [0.0, 0.0]] and r.n_known == 1


def test_clean_example(spark):
    df = spark.createDataFrame([(0, "The, small) Grey cats; climb uP- tHe walL! m[o]p."), (1, "the m o !")],
                               "Id long, Title string")
    lemmas = spark.createDataFrame([("cats", "cat")], "token string, lemma string")
    block = ["the", "m", "o"] + list("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
    got = {r.Id: r for r in X.clean(df, "Title", blocklist=block, lemmas=lemmas).collect()}
    assert got[0].clean_tokens == ["small", "Grey", "cat", "climb", "uP-", "walL", "p"]
    assert got[0].clean_text == "small Grey cat climb uP- walL p "
    assert got[1].clean_tokens == [] and got[1].clean_text == ""


def test_suffix_lemmas(spark):
    toks = spark.createDataFrame([("jumps",), ("boxes",), ("women",), ("flies",), ("Cats",), ("glass",),
                                  ("firemen",)], "t string")
    dic = spark.createDataFrame([("jump",), ("box",), ("woman",), ("fly",), ("cat",), ("glas",),
                                 ("fireman",), ("firemen",), ("jumps",)], "w string")
    got = {r.token: r.lemma for r in X.suffix_lemmas(toks, dic).collect()}
    # "firemen" is listed itself and ties with "fireman": it stays; "jumps"
    # is listed but "jump" is shorter
    assert got == {"jumps": "jump", "boxes": "box", "women": "woman", "flies": "fly", "glass": "glas"}


def test_remove_tokens_strategies_agree(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").alias("Id"), tokenize_basic("text").alias("tokens"))
    a = X.remove_tokens(docs, "tokens", out="k", strategy="array").select("Id", "k")
    b = X.remove_tokens(docs, "tokens", out="k", strategy="join").select("Id", "k")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    blocked = set(X.token_blocklist())
    for r in a.collect():
        assert not any(t.lower() in blocked for t in r.k)


def test_build_vocab_order_and_ids(spark):
    df = spark.createDataFrame([(["b", "a", "b", "c"],), (["c", "b", "d"],)], "t array<string>")
    got = [(r.token, r.id, r["count"]) for r in X.build_vocab(df, "t", 3).orderBy("id").collect()]
    assert got == [("b", 4, 3), ("c", 5, 2), ("a", 6, 1)]


def test_length_profile_exact_median(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        tokenize_basic("text").alias("t"))
    lens = [len(r.t) for r in docs.collect()]
    p = X.length_profile(docs, "t").first()
    assert p.n_titles == len(lens) and p.max_tokens == max(lens) and p.min_tokens == min(lens)
    assert abs(p.mean_tokens - statistics.mean(lens)) < 1e-9
    assert p.median_tokens == float(statistics.median(lens))
    odd = spark.createDataFrame([([1],), ([1, 2, 3],), ([1, 2],)], "t array<int>")
    assert X.length_profile(odd, "t").first().median_tokens == 2.0


def test_matrix_features(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0], [0.0, 0.0]],)], "m array<array<float>>")
    r = df.select(X.matrix_features("m", 2, "mean").alias("a"), X.matrix_features("m", 2, "concat").alias("b")).first()
    assert [round(v, 6) for v in r.a] == [round(4 / 3, 6), 2.0] and r.b == [1.0, 2.0, 3.0, 4.0, 0.0, 0.0]


@pytest.mark.parametrize("rows", [200_000, 0])
def test_lookups_keep_repeated_and_null_keys(spark, monkeypatch, rows):
    """The batch lookup and the shuffled one (no small tables) give the same."""
    monkeypatch.setattr(X, "LOOKUP_ROWS", rows)
    df = spark.createDataFrame([(1, ["a", "The", None]), (1, ["b"]), (None, ["b", "x"]), (None, []), (2, None),
                                (3, ["a", "a"]), (3, ["a", "a"])], "Id long, tokens array<string>")
    vocab = spark.createDataFrame([("a", 4), ("b", 5)], "token string, id int")
    enc = sorted(tuple(r.input_ids) for r in X.encode(df, "tokens", vocab, max_len=5).collect())
    assert enc == sorted([(1, 4, 3, 3, 2), (1, 5, 2, 0, 0), (1, 5, 3, 2, 0), (1, 2, 0, 0, 0), (1, 2, 0, 0, 0),
                          (1, 4, 4, 2, 0), (1, 4, 4, 2, 0)])
    vec = spark.createDataFrame([("a", [1.0]), ("b", [2.0])], "token string, vector array<float>")
    emb = sorted(([v[0] for v in r.embedded], r.n_known) for r in X.embed_tokens(df, "tokens", vec, 1, length=2).collect())
    assert len(emb) == 7 and emb.count(([1.0, 1.0], 2)) == 2 and ([2.0, 0.0], 1) in emb
    kept = X.remove_tokens(df, "tokens", ["the", "b"], out="k", strategy="join").select("Id", "k").collect()
    assert sorted(kept, key=str) == sorted([(1, ["a", None]), (1, []), (None, ["x"]), (None, []), (2, []),
                                            (3, ["a", "a"]), (3, ["a", "a"])], key=str)
    lem = X.lemmatize(df, "tokens", spark.createDataFrame([("a", "z")], "token string, lemma string"), out="l")
    assert sorted(str(r.l) for r in lem.collect()) == sorted(map(str, [
        ["z", "The", None], ["b"], ["b", "x"], [], [], ["z", "z"], ["z", "z"]]))
    empty = X.encode(df, "tokens", vocab.limit(0), max_len=4).collect()
    assert len(empty) == 7 and X.encode(df.limit(0), "tokens", vocab).count() == 0
