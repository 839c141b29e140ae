"""Treebank tokens by hand-written rows."""

import pytest
from pyspark.sql import functions as F

from titleflow.functions import sentences_treebank, tokenize_treebank
from titleflow.operators import text as X

ROWS = [
    ("I don't know; it's Bob's.", "I do n't know ; it 's Bob 's ."),
    ("They'll say we've won, you'd hope", "They 'll say we 've won , you 'd hope"),
    ("He'd've gone. She cannot! Gimme 3,500.50 at 10:30, ok?", "He 'd 've gone . She can not ! Gim me 3,500.50 at 10:30 , ok ?"),
    ('"Well-known" (he said) "quotes."', "`` Well-known '' ( he said ) `` quotes . ''"),
    ("Mr. J. K. Smith of the U.S. left", "Mr. J. K. Smith of the U.S. left"),
    ("a.b.c is one... two -- three", "a.b.c is one ... two -- three"),
    ("the dogs' bowl", "the dogs ' bowl"),
    ("The, quick) Brown fox; jumps oVer- tHe lazY! d[o]g.", "The , quick ) Brown fox ; jumps oVer- tHe lazY ! d [ o ] g ."),
    ("wait,, what", "wait ,, what"),
    ("trailing comma,", "trailing comma ,"),
    ("\x01odd\x02 marks", "odd marks"),
    ("Élan isn't über.", "Élan is n't über ."),
]


@pytest.mark.parametrize("as_sentences", [False, True])
def test_hand_written_rows(spark, as_sentences):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(ROWS)], "Id long, t string")
    if as_sentences:
        got = {r.Id: [w for s in r.x for w in s] for r in df.select("Id", sentences_treebank("t").alias("x")).collect()}
    else:
        got = {r.Id: r.x for r in df.select("Id", tokenize_treebank("t").alias("x")).collect()}
    assert [" ".join(got[i]) for i in range(len(ROWS))] == [w for _, w in ROWS]


def test_sentences(spark):
    text = 'Dr. Who came. "It is late!" He left at 5 p.m. on No. 7. done? 3 stayed.'
    df = spark.createDataFrame([(text,)], "t string")
    got = [" ".join(s) for s in df.select(sentences_treebank("t")).first()[0]]
    assert got == ["Dr. Who came .", "`` It is late ! ''", "He left at 5 p.m. on No. 7. done ?", "3 stayed ."]


def test_null_empty_and_long_texts(spark):
    df = spark.createDataFrame([(0, None), (1, ""), (2, " \n "), (3, "No end. " * 50_000)], "Id long, t string")
    got = {r.Id: r for r in df.select("Id", tokenize_treebank("t").alias("x"), sentences_treebank("t").alias("s")).collect()}
    assert got[0].x is None and got[0].s is None
    assert got[1].x == [] and got[2].x == [] and got[2].s == []
    assert len(got[3].s) == 50_000 and len(got[3].x) == 150_000


def test_clean_by_treebank_tokens(spark):
    df = spark.createDataFrame([(0, "The dog doesn't bark, it's Bob's.")], "Id long, Title string")
    r = X.clean(df, words_of=tokenize_treebank, blocklist=["the", "it", ",", "."]).first()
    assert r.clean_tokens == ["dog", "does", "n't", "bark", "'s", "Bob", "'s"]
    assert r.clean_text == "dog does n't bark 's Bob 's "


def test_rules_are_skipped_where_no_match_can_be(spark):
    """Rules that need a certain string run only on texts that hold it, with the same result as all rules in order."""
    from titleflow.functions import text as T
    cases = ["", "plain words only", "cannot cannot gonna", "He said \"don't\" ... N'T WON'T went--home; 3:45", "\x01 a\x02b",
             "'x' (y)!? {it}. U.S.A. Mr. X wanna gimme lemme gotta", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i int, t string")
    plain = F.concat(F.lit(" "), "t", F.lit(" "))
    for pattern, replacement in T.treebank_rules():
        plain = F.regexp_replace(plain, pattern, replacement)
    want = T._words_of(F.replace(plain, F.lit("\x01"), F.lit(".")))
    rows = df.select(T.tokenize_treebank("t").alias("a"), want.alias("b")).collect()
    assert [r.a for r in rows] == [r.b for r in rows]
    assert set(T._needs()) <= {p for p, _ in T.treebank_rules()} and len(T._needs()) == 14
