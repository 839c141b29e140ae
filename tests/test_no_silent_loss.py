"""Rows, labels and vectors that must not vanish without a word."""

import math

import pytest
from pyspark.sql import functions as F

from titleflow.operators import metrics as M
from titleflow.operators import sampling as S
from titleflow.operators.joins import align_labels, lookup_join
from titleflow.operators.text import build_vocab
from titleflow.sources import read_token_vectors, read_vocab, without_labels


def _keys(spark, n, every=40):
    return spark.range(n).select(F.when(F.col("id") % every != 0, F.col("id")).alias("Id"), F.col("id").alias("v"))


@pytest.mark.parametrize("n", [12, 200, 10_000])
def test_null_keys_keep_their_rows(spark, n):
    df = _keys(spark, n)
    rows = S.with_position(df, "Id").collect()
    assert sorted(r.pos for r in rows) == list(range(n))
    nulls = [r.pos for r in rows if r.Id is None]
    assert sorted(nulls) == list(range(len(nulls)))  # NULL keys come first
    keyed = sorted((r.pos, r.Id) for r in rows if r.Id is not None)
    assert [i for _, i in keyed] == sorted(i for _, i in keyed)
    shuffled = S.with_position(df, "Id", seed=3).collect()
    assert sorted(r.pos for r in shuffled) == list(range(n))
    again = S.with_position(df.repartition(7), "Id", seed=3).collect()
    assert {r.v: r.pos for r in shuffled} == {r.v: r.pos for r in again}
    split = dict(S.split_exact(df, "Id", 0.9, 7).groupBy("split").count().collect())
    cut = math.floor(0.9 * n)
    assert split == {"train": cut, "validation": n - cut}


def test_null_groups_and_null_only_keys(spark):
    df = spark.range(30).select(F.col("id").alias("Id"), F.when(F.col("id") % 3 == 0, F.lit("a")).alias("g"))
    rows = S.with_position(df, "Id", partition_by="g", seed=1).collect()
    assert len(rows) == 30 and sorted(r.pos for r in rows if r.g is None) == list(range(20))
    none = spark.range(9).select(F.lit(None).cast("long").alias("Id"), F.col("id").alias("v"))
    assert sorted(r.pos for r in S.with_position(none, "Id").collect()) == list(range(9))
    assert S.with_position(none.limit(0), "Id").count() == 0


def test_text_keys_are_refused_for_a_natural_order(spark):
    with pytest.raises(TypeError, match="numeric"):
        S.with_position(spark.createDataFrame([("b",), ("a",)], "Id string"), "Id")


@pytest.mark.parametrize("buckets", [1, 16, 5000])
def test_bucket_count_is_exact(spark, buckets):
    df = spark.range(3000).select(F.col("id").alias("Id"))
    keyed, offsets = S._bucketed(df, "Id", [], 5, (), buckets)
    top = keyed.agg(F.max(S._BUCKET)).first()[0]
    assert 0 <= top < buckets and (buckets > 100 or offsets.count() == buckets)


def test_placeholder_labels_take_the_real_ones(spark):
    x = without_labels(spark.createDataFrame([(1, "a"), (2, "b")], "Id long, Title string"))
    y = spark.createDataFrame([(1, 3), (2, 4)], "Id long, Genre int")
    got = align_labels(x, y)
    assert got.columns == ["Id", "Title", "Genre"]
    assert sorted((r.Id, r.Genre) for r in got.collect()) == [(1, 3), (2, 4)]
    half = align_labels(x, y.where("Id = 1"), how="left", check="unique")
    assert sorted((r.Id, r.Genre) for r in half.collect()) == [(1, 3), (2, None)]


def test_labels_outside_the_classes_are_counted(spark):
    df = spark.createDataFrame([(0, 0), (1, 7), (1, None), (1, -2)], "pred int, Genre int")
    rows = {r["class"]: (r.n, r.n_correct) for r in M.per_class_accuracy(df, 2).collect()}
    assert rows == {0: (1, 1), 1: (0, 0), -1: (3, 0)}


def test_missing_losses_fail(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None)], "Id long, loss double")
    with pytest.raises(Exception, match="without a loss"):
        M.batch_mean_loss(df, 2).collect()


def test_token_vectors_with_blanks_and_bad_lines(spark, tmp_path):
    path = tmp_path / "v.txt"
    path.write_text("a 1 2\ntwo words 3 4 \n\n. . . 5 6\n")
    got = {r.token: r.vector for r in read_token_vectors(spark, str(path), 2).collect()}
    assert got == {"a": [1.0, 2.0], "two words": [3.0, 4.0], ". . .": [5.0, 6.0]}
    path.write_text("a 1 2\nbad 1\n")
    with pytest.raises(Exception, match="no token with 2 values"):
        read_token_vectors(spark, str(path), 2).collect()


def test_vocabulary_of_several_files_is_refused(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.txt").write_text("x\ny\n")
    with pytest.raises(ValueError, match="one file"):
        read_vocab(spark, str(tmp_path))


def test_full_vocabulary(spark):
    df = spark.range(500).select(F.array(F.lit("the"), F.concat(F.lit("w"), F.col("id") % 90), F.lit(None)).alias("t"))
    got = [(r.token, r.id, r["count"]) for r in build_vocab(df, "t").collect()]
    counts = {"the": 500} | {f"w{i}": len(range(i, 500, 90)) for i in range(90)}
    want = [(t, i + 4, n) for i, (t, n) in enumerate(sorted(counts.items(), key=lambda x: (-x[1], x[0])))]
    assert sorted(got, key=lambda x: x[1]) == want
    assert build_vocab(df.limit(0), "t").count() == 0
    assert [r.token for r in build_vocab(df, "t", 1).collect()] == ["the"]


def test_salted_lookup_over_a_shuffled_input(spark):
    df = spark.range(20_000).select(F.col("id"), F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 997)
                                    .alias("k")).repartition(13)
    table = spark.range(-1, 997).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    out = lookup_join(df, table, "k", max_broadcast_rows=10, salt_by=["id"], sample_fraction=0.3, hot_share=0.01)
    assert out.count() == 20_000 and out.where("x is null or x <> 2 * k").count() == 0
