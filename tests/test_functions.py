import re

import pytest
from pyspark.sql import functions as F

from titleflow.functions import (argmax, basic_english_rules, cross_entropy, fit_length,
                                 multiply, tokenize_basic, tokenize_words)
from titleflow.operators.models import ensemble

TITLES = [
    (0, "It's a Test, (really)!"),
    (1, 'a "q", b'),
    (2, ""),
    (3, "Ünïcode: Straße; NA"),
]


def test_tokenize_basic_fixture(spark):
    df = spark.createDataFrame(TITLES, "Id long, Title string")
    got = {r.Id: r.t for r in df.select("Id", tokenize_basic("Title").alias("t")).collect()}
    assert got[0] == ["it", "'", "s", "a", "test", ",", "(", "really", ")", "!"]
    assert got[1] == ["a", "q", ",", "b"]
    assert got[2] == []
    assert got[3] == ["ünïcode", "straße", "na"]


def _python_basic(line):
    line = line.lower()
    for pat, rep in basic_english_rules():
        line = re.sub(pat, rep, line)
    return line.split()


def test_fused_rules_equal_sequential_rules_on_whole_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    extra = spark.createDataFrame(
        [(10**6, 'x<br />y "a.b" c\'d (e)! f? g; h: i,,j <br "/>'),
         (10**6 + 1, "tab\tnew\nline nbsp em  end. ")],
        "doc_id long, text string")
    rows = (docs.select("doc_id", "text").unionByName(extra)
            .select("doc_id", "text", tokenize_basic("text").alias("t")).collect())
    assert len(rows) >= 200
    for r in rows:
        assert r.t == _python_basic(r.text), r.doc_id


def test_tokenize_words_clean_example(spark):
    df = spark.createDataFrame([("The, small) Grey cats; climb uP- tHe walL! m[o]p.",)], "s string")
    toks = df.select(tokenize_words("s").alias("t")).first().t
    assert toks == ["The", ",", "small", ")", "Grey", "cats", ";", "climb", "uP-", "tHe",
                    "walL", "!", "m", "[", "o", "]", "p", "."]


def test_fit_length(spark):
    df = spark.createDataFrame([(["a"],), (["a", "b", "c", "d", "e"],), ([],), (None,)],
                               "a array<string>")
    got = [r.f for r in df.select(fit_length("a", 3, "").alias("f")).collect()]
    assert got == [["a", "", ""], ["a", "b", "c"], ["", "", ""], ["", "", ""]]


def test_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],), ([-2.0, -1.0, -5.0],), ([float("nan"), 1.0, 2.0],)],
                               "z array<double>")
    assert [r.p for r in df.select(argmax("z").alias("p")).collect()] == [1, 1, 0]


def test_cross_entropy(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0], 1)], "z array<double>, y int")
    v = df.select(cross_entropy("z", "y").alias("l")).first().l
    assert round(v, 9) == round(0.7586236756795133, 9)


def test_multiply_and_ensemble(spark):
    a = spark.createDataFrame([(1, [-2.0, 1.0, 0.5])], "Id long, z array<double>")
    b = spark.createDataFrame([(1, [-3.0, 1.0, 0.5])], "Id long, z array<double>")
    assert a.select(multiply("z", F.array(F.lit(2.0), F.lit(2.0), F.lit(2.0))).alias("m")).first().m == [-4.0, 2.0, 1.0]
    raw = ensemble(a, b, on="Id", mode="raw").first()
    assert raw.z == [6.0, 1.0, 0.25] and raw.pred == 0 and raw.pred_a == 1 and raw.pred_b == 1
    assert ensemble(a, b, on="Id", mode="probability").first().pred == 1
    with pytest.raises(ValueError):
        ensemble(a, b, mode="other")


def test_first_basic_tokens_are_those_of_the_whole_text(spark):
    texts = [t for _, t in TITLES] + [None, " ", " ; :\n", 'say "a"b ... c<br />d; "e', "x" * 5000 + " y z", "\x85a b:c\n'd'",
                                      "\n;  A (b)\n" * 400]
    df = spark.createDataFrame([(t,) for t in texts], "Title string")
    for n in (0, 1, 3, 15):
        got = df.select(tokenize_basic("Title").alias("all"), tokenize_basic("Title", first=n).alias("first")).collect()
        assert [r["first"] for r in got] == [None if r["all"] is None else r["all"][:n] for r in got]


def test_title_vectors_read_off_first_tokens_only(spark, monkeypatch):
    """The title vectors hold 15 tokens: no pass of theirs reads off a whole text's."""
    from titleflow.functions import text
    from titleflow.plans import model_queries as Q
    asked, whole = [], text.tokenize_basic
    monkeypatch.setattr(text, "tokenize_basic", lambda t, first=None: (asked.append(first), whole(t, first))[1])
    docs = spark.createDataFrame([(i, "one two; three " * (i + 1)) for i in range(20)], "Id long, Title string")
    vectors = spark.createDataFrame([(i, [float(i)] * 64) for i in range(3)], "vec_id long, embedding array<float>")
    monkeypatch.setattr(Q, "read_table", lambda *a: vectors)
    got = {r.Id: r.vec for r in Q._document_vectors(spark, "", docs, docs).collect()}
    # one, three and two by frequency and name; 3 (i + 1) tokens of a title, 15 at most
    want = {i: min(5, i + 1) * 3 / 15 for i in range(20)}
    assert {i: round(v[0], 9) for i, v in got.items()} == {i: round(x, 9) for i, x in want.items()}
    assert asked == [None, 15]  # the vocabulary counts all tokens, the titles need 15
