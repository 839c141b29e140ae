import os

import pytest
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from titleflow.operators import models as MD
from titleflow.operators import sampling as S
from titleflow.operators.tuning import best_run, random_search

SF = "/root/testdata/sf0.01"


def _emb(spark):
    e = spark.read.parquet(f"{SF}/embeddings.parquet")
    return e.select(F.col("vec_id").alias("Id"), "embedding", F.col("label").alias("Genre"))


def test_vector_model_learns(spark):
    df = _emb(spark)
    model = MD.fit_vectors(df, "embedding", [64, 32, 10], max_iter=100, seed=1)
    scored = MD.score(model, df, features="embedding", keep=["Id", "Genre"])
    r = scored.first()
    assert len(r.z) == 10 and 0 <= r.pred < 10
    acc = scored.agg(F.avg((F.col("pred") == F.col("Genre")).cast("double"))).first()[0]
    majority = df.groupBy("Genre").count().agg(F.max("count")).first()[0] / df.count()
    assert acc > majority
    ev = MD.evaluate(model, df, 50, features="embedding").first()
    assert ev.n_batches == 10 and 0 <= ev.val_accuracy <= 1 and ev.val_loss > 0


def test_title_model_and_search(spark):
    parts = spark.read.parquet("/root/testdata/sf0.001/part.parquet").select(
        F.col("p_partkey").alias("Id"), F.col("p_name").alias("Title"),
        (F.col("p_size") % 3).alias("Genre"))
    m = MD.fit_title(parts, num_features=1 << 10, max_iter=5)
    out = MD.score(m, parts, keep=["Id"])
    assert out.count() == parts.count()
    hist = MD.training_history(m.pipeline)
    assert 1 <= len(hist) <= 6 and all(h > 0 for h in hist)
    data = S.split_exact(_emb(spark), "Id", 0.8, 1)
    train = MD.vector_features(data.where("split = 'train'"), "embedding").withColumn(
        "Genre", F.col("Genre").cast("double"))
    val = data.where("split = 'validation'")
    from pyspark.ml.classification import LogisticRegression
    lr = LogisticRegression(labelCol="Genre", family="multinomial")
    grid = ParamGridBuilder().addGrid(lr.regParam, [0.0, 0.1]).addGrid(lr.maxIter, [5, 10]).build()
    res = random_search(lr, grid, train, val, k=2, seed=3,
                        evaluate=lambda mm, v: MD.evaluate(mm, v, 25, features="embedding"))
    assert res.count() == 2 and {"run_id", "params", "val_accuracy", "val_loss"} <= set(res.columns)
    assert best_run(res).count() == 1


def test_search_evaluates_all_models_in_one_scan(spark):
    data = S.split_exact(_emb(spark), "Id", 0.8, 1)
    train = MD.vector_features(data.where("split = 'train'"), "embedding").withColumn("Genre", F.col("Genre").cast("double"))
    val = data.where("split = 'validation'").select("Id", "embedding", "Genre")
    est = MD.vector_estimator([64, 8, 10], solver="gd", seed=1)
    grid = ParamGridBuilder().addGrid(est.stepSize, [1e-3, 1e-2]).addGrid(est.maxIter, [2, 5]).build()
    one = random_search(est, grid, train, val, k=3, seed=3,
                        evaluate=lambda m, v: MD.evaluate(m, v, 25, features="embedding", digits=6))
    seen = []

    def all_models(models, v):
        seen.append((len(models), MD.evaluate_all(models, v, 25, features="embedding", digits=6)))
        return seen[-1][1]

    all_ = random_search(est, grid, train, val, k=3, seed=3, evaluate_all=all_models, parallelism=2)
    columns = sorted(one.columns)
    assert sorted(all_.columns) == columns
    assert sorted(all_.select(columns).collect()) == sorted(one.select(columns).collect())
    assert [n for n, _ in seen] == [3]
    plan = seen[0][1]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") + plan.count("LogicalRDD [") == 1, plan


def test_search_needs_one_way_to_evaluate(spark):
    with pytest.raises(ValueError):
        random_search(None, [], None, None, k=1, seed=1)
    with pytest.raises(ValueError):
        MD.evaluate_all([], _emb(spark), 5, features="embedding")


def test_streaming_tokenise_and_predict(spark, tmpdir_path):
    from titleflow.streaming.scoring import predict_stream, read_features_stream, with_tokens
    src = os.path.join(tmpdir_path, "in")
    os.makedirs(src)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(
        F.col("doc_id").alias("Id"), F.lit("x.bmp").alias("Cover"), F.col("text").alias("Title"))
    docs.coalesce(2).write.option("header", True).option("escape", '"').mode("overwrite").csv(src + "/batch1")
    stream = read_features_stream(spark, src + "/batch1")
    q = (with_tokens(stream).select("Id", F.size("tokens").alias("n")).writeStream
         .format("memory").queryName("tf_stream_tokens").outputMode("append").start())
    q.processAllAvailable()
    q.stop()
    assert spark.table("tf_stream_tokens").count() == docs.count()
    labelled = docs.withColumn("Genre", (F.col("Id") % 2).cast("int"))
    model = MD.fit_title(labelled, num_features=1 << 10, max_iter=3)
    q2 = (predict_stream(model, read_features_stream(spark, src + "/batch1")).writeStream
          .format("memory").queryName("tf_stream_pred").outputMode("append").start())
    q2.processAllAvailable()
    q2.stop()
    assert spark.table("tf_stream_pred").count() == docs.count()


def test_streaming_file_sink(spark, tmpdir_path):
    from titleflow.streaming.scoring import predict_stream, read_features_stream, write_predictions
    src = os.path.join(tmpdir_path, "in")
    rows = [(i, "x.bmp", f"title {i % 3} words") for i in range(30)]
    spark.createDataFrame(rows, "Id long, Cover string, Title string").coalesce(1).write \
        .option("header", True).csv(src)
    labelled = spark.createDataFrame([(i, t, i % 3) for i, _, t in rows], "Id long, Title string, Genre int")
    model = MD.fit_title(labelled, num_features=1 << 8, max_iter=20)
    out = os.path.join(tmpdir_path, "out")
    q = write_predictions(predict_stream(model, read_features_stream(spark, src)), out,
                          checkpoint=os.path.join(tmpdir_path, "ck"), trigger_once=True)
    q.awaitTermination(120)
    back = spark.read.option("header", True).schema("Id long, Genre int").csv(out)
    assert back.count() == 30 and back.where("Genre is null").count() == 0
