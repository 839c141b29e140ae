import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from titleflow.operators import metrics as M
from titleflow.operators import models as MD
from titleflow.operators import permutation as P
from titleflow.operators.joins import KeyCheckError, align_labels
from titleflow.operators.positional import pair_by_position, with_file_position
from titleflow.sources import read_metrics, replace_metrics


def _write(spark, path, n, parts, fmt="parquet", start=0):
    """``n`` rows in file order, cut over ``parts`` files."""
    rows = spark.range(start, start + n, 1, parts).select(F.col("id").alias("Id"), F.concat(F.lit("t"), "id").alias("Title"))
    rows.write.format(fmt).option("header", True).save(path)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_file_positions_follow_files_and_rows(spark, tmpdir_path, fmt):
    path = f"{tmpdir_path}/x"
    _write(spark, path, 1000, 7, fmt)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")  # several splits a file
    try:
        rows = spark.read.format(fmt).schema("Id long, Title string").option("header", True).load(path)
        got = {r.Id: r.pos for r in with_file_position(rows).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == {i: i for i in range(1000)}


def test_file_positions_need_no_shuffle_of_the_rows(spark, tmpdir_path):
    _write(spark, f"{tmpdir_path}/x", 200, 3)
    plan = with_file_position(spark.read.parquet(f"{tmpdir_path}/x"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and "Exchange hashpartitioning" not in plan


def test_pairs_with_repeated_and_null_rows(spark, tmpdir_path):
    x = spark.createDataFrame([("a", 1), (None, None), ("a", 1), ("b", 2)], "Title string, v int").coalesce(1)
    y = spark.createDataFrame([(None, 5), (1, 6), (1, 7), (3, 8)], "Genre int, v int").coalesce(1)
    x.write.parquet(f"{tmpdir_path}/x")
    y.write.parquet(f"{tmpdir_path}/y")
    x, y = spark.read.parquet(f"{tmpdir_path}/x"), spark.read.parquet(f"{tmpdir_path}/y")
    got = sorted((r.pos, r.Title, r.v, r.Genre, r.y_v) for r in align_labels(x, y, on="position").collect())
    assert got == [(0, "a", 1, None, 5), (1, None, None, 1, 6), (2, "a", 1, 1, 7), (3, "b", 2, 3, 8)]
    y.limit(2).coalesce(1).write.parquet(f"{tmpdir_path}/z")
    z = spark.read.parquet(f"{tmpdir_path}/z")
    with pytest.raises(KeyCheckError):
        align_labels(x, z, on="position")
    assert pair_by_position(x, z, lengths="shortest").count() == 2
    left = align_labels(x, z, on="position", how="left")
    assert sorted(r.pos for r in left.where("y_v is null").collect()) == [2, 3]
    with pytest.raises(KeyCheckError):
        align_labels(z, x, on="position", how="left")
    with pytest.raises(ValueError):
        with_file_position(spark.range(3).toDF("Id"))


def test_empty_files_have_no_positions(spark, tmpdir_path):
    spark.range(0).toDF("Id").write.parquet(f"{tmpdir_path}/x")
    empty = spark.read.parquet(f"{tmpdir_path}/x")
    assert with_file_position(empty).count() == 0 and pair_by_position(empty, empty).count() == 0


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 4097])
def test_permutation_is_a_bijection_and_differs_by_epoch(spark, n):
    each = P.permuted_epochs(spark.range(n).toDF("pos"), n, 3, 10)
    rows = each.collect()
    orders = [[r.epoch_pos for r in sorted(rows, key=lambda r: r.pos) if r.epoch == e] for e in range(3)]
    for o in orders:
        assert sorted(o) == list(range(n))
    if n > 10:
        assert orders[0] != orders[1] != orders[2]
    if n >= 1000:  # no trace of the old order: neighbours are far apart, places and numbers uncorrelated
        for o in orders:
            assert abs(np.corrcoef(np.arange(n), o)[0, 1]) < 0.1
            assert abs(np.corrcoef(o[:-1], o[1:])[0, 1]) < 0.1
    assert all(r.batch_id == r.epoch_pos // 10 for r in rows)


def test_permutation_needs_no_exchange_and_keeps_nulls(spark):
    df = spark.createDataFrame([(0, "a"), (None, "b"), (1, "c")], "pos long, epoch_pos string")
    got = P.permuted_epochs(df.drop("epoch_pos"), 2, 1, 1)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert [r for r in got.collect() if r.pos is None][0].epoch_pos is None


def _forward(weights, layers, x):
    """Raw outputs of the network from its flat weights."""
    at = 0
    for k, (i, o) in enumerate(zip(layers[:-1], layers[1:], strict=True)):
        w = weights[at:at + i * o].reshape(i, o)
        b = weights[at + i * o:at + i * o + o]
        at += i * o + o
        x = x @ w + b
        if k < len(layers) - 2:
            x = 1 / (1 + np.exp(-x))
    return x


def test_epoch_training_equals_a_recomputation_from_the_weights(spark, tmpdir_path):
    r = np.random.default_rng(1)
    centres = r.standard_normal((3, 6)) * 3
    rows = [(i, (centres[i % 3] + r.standard_normal(6)).tolist(), i % 3) for i in range(260)]
    df = spark.createDataFrame(rows, "Id long, x array<double>, Genre int")
    train, val = df.where("Id < 200"), df.where("Id >= 200")
    layers, size, seed = [6, 5, 3], 32, 9
    models, log = MD.fit_epochs(train, val, "x", layers, epochs=3, size=size, iterations=4, seed=seed, run_id="r1")
    assert len(models) == 3 and log.count() == 9

    def losses(part, model, order):
        z = _forward(model.weights.toArray(), layers, np.array([x for _, x, _ in part]))
        y = np.array([g for _, _, g in part])
        loss = np.log(np.exp(z - z.max(1, keepdims=True)).sum(1)) + z.max(1) - z[np.arange(len(y)), y]
        batches = [np.array([i for i in range(len(part)) if order[i] // size == b]) for b in range(-(-len(part) // size))]
        return np.mean([loss[b].mean() for b in batches]), np.mean([(z[b].argmax(1) == y[b]).mean() for b in batches])

    history = {h.epoch: h for h in M.epoch_history(log).collect()}
    assert sorted(history) == [1, 2, 3]
    places = P.permuted_epochs(spark.range(200).toDF("pos"), 200, 3, size, seed).collect()
    for e in range(3):
        order = {p.pos: p.epoch_pos for p in places if p.epoch == e}
        t, _ = losses(rows[:200], models[e], order)
        v, acc = losses(rows[200:], models[e], {i: i for i in range(60)})
        assert math.isclose(history[e + 1].training_loss, t, rel_tol=1e-9)
        assert math.isclose(history[e + 1].valid_loss, v, rel_tol=1e-9)
        assert math.isclose(history[e + 1].valid_accur, acc, rel_tol=1e-12)
    assert history[3].training_loss < history[1].training_loss  # it goes on from the weights before

    path = f"{tmpdir_path}/log"
    replace_metrics(log, path)
    replace_metrics(log, path)  # a retried write doubles nothing
    replace_metrics(log.withColumn("run_id", F.lit("r2")), path)
    back = read_metrics(spark, path)
    assert back.count() == 18 and back.where("run_id = 'r1'").exceptAll(log).count() == 0


def test_epoch_training_refuses_labels_outside_the_outputs(spark):
    df = spark.createDataFrame([(i, [float(i), 1.0], i % 2) for i in range(20)], "Id long, x array<double>, Genre int")
    bad = df.withColumn("Genre", F.lit(7))
    with pytest.raises(Exception, match="label outside"):
        MD.fit_epochs(df, bad, "x", [2, 2], epochs=1, size=4, iterations=1)


def test_stored_positions_read_only_the_folders_they_need(spark, tmpdir_path):
    from titleflow.operators.position_store import fetch_positions, store_positions
    rows = spark.range(5000).select((4999 - F.col("id")).alias("Id"), F.concat(F.lit("t"), 4999 - F.col("id")).alias("pos"))
    store_positions(rows, f"{tmpdir_path}/x", "Id", bucket_rows=100)
    got = fetch_positions(spark, f"{tmpdir_path}/x", [4, 205, 205, 4999, 5000, -1], out="at")
    assert sorted((r.at, r.Id, r.pos) for r in got.collect()) == [(4, 4, "t4"), (205, 205, "t205"), (205, 205, "t205"), (4999, 4999, "t4999")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [__tf_folder" in plan
    many = spark.range(0, 5000, 3).toDF("p").unionByName(spark.createDataFrame([(None,)], "p long"))
    assert sorted(r.pos for r in fetch_positions(spark, f"{tmpdir_path}/x", many).collect()) == list(range(0, 5000, 3))
    assert fetch_positions(spark, f"{tmpdir_path}/x", []).count() == 0
