"""Registered model queries. Training results depend on
solver numerics, so these have no SQL oracle; the driver checks rows."""

from __future__ import annotations

from pyspark.ml.feature import StringIndexer
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.functions.arrays import argmax
from titleflow.operators import models as MD
from titleflow.operators import sampling as S
from titleflow.operators import tuning as TU
from titleflow.operators.partitioning import spread
from titleflow.session import cut_lineage
from titleflow.sources.tables import read_table

SEED = 42


def _part_titles(spark, sf) -> DataFrame:
    """``part`` as a title table with dense class ids for ``p_type``.

    StringIndexer collects only the distinct class names (six) to the
    driver and ranks them alphabetically, so ids are stable."""
    p = read_table(spark, sf, "part").select(F.col("p_partkey").alias("Id"),
                                             F.col("p_name").alias("Title"), "p_type")
    idx = StringIndexer(inputCol="p_type", outputCol="Genre", stringOrderType="alphabetAsc")
    return idx.fit(p).transform(p).withColumn("Genre", F.col("Genre").cast("int")).drop("p_type")


def _emb_table(spark, sf) -> DataFrame:
    e = read_table(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("Id"), "embedding", F.col("label").alias("Genre"))


def score_title_model(spark, sf):
    data = S.split_exact(_part_titles(spark, sf), "Id", 0.9, SEED)
    train = data.where(F.col("split") == "train")
    val = data.where(F.col("split") == "validation")
    model = MD.fit_title(train, text="Title", label="Genre")
    return MD.score(model, val, keep=["Id", "Genre"]).select("Id", "Genre", "pred")


def _vector_split(spark, sf):
    data = S.split_exact(_emb_table(spark, sf), "Id", 0.9, SEED)
    return (data.where(F.col("split") == "train").drop("split"),
            data.where(F.col("split") == "validation").drop("split"))


def score_vector_model(spark, sf):
    train, val = _vector_split(spark, sf)
    model = MD.fit_vectors(train, "embedding", [64, 32, 10], label="Genre", seed=SEED)
    return MD.score(model, val, features="embedding", keep=["Id", "Genre"]).select("Id", "Genre", "pred")


def evaluate_vector_model(spark, sf):
    train, val = _vector_split(spark, sf)
    model = MD.fit_vectors(train, "embedding", [64, 32, 10], label="Genre", seed=SEED)
    return MD.evaluate(model, val, 50, key="Id", label="Genre", features="embedding", digits=6)


def epoch_training(spark, sf):
    """Three rounds of training on the ``embeddings`` vectors, evaluated after
    each: the metric log read back as one row per epoch."""
    from titleflow.operators.metrics import epoch_history
    train, val = _vector_split(spark, sf)
    _, log = MD.fit_epochs(train, val, "embedding", [64, 32, 10], epochs=3, size=50, iterations=10, seed=SEED)
    return epoch_history(log, digits=6)


def random_search(spark, sf, k: int = 3):
    """Seeded random search over a 4 x 3 x 4 = 48-point grid of the MLP on
    the ``embeddings`` vectors: step size (learning rate of the gradient-descent
    solver) x hidden width x iterations, defaults 1e-3 / 32 / 30; ``k``
    sampled settings are fitted and scored on the fixed validation split."""
    train, val = _vector_split(spark, sf)
    train = MD.vector_features(train, "embedding").withColumn("Genre", F.col("Genre").cast("double"))
    val = val.select("Id", "embedding", "Genre")
    mlp = MD.vector_estimator([64, 32, 10], label="Genre", solver="gd", seed=SEED)
    # fixed values: step sizes, iterations and defaults of the search
    grid = (ParamGridBuilder()
            .addGrid(mlp.stepSize, [1e-5, 1e-4, 1e-3, 1e-2])
            .addGrid(mlp.layers, [[64, 16, 10], [64, 32, 10], [64, 64, 10]])
            .addGrid(mlp.maxIter, [10, 30, 50, 70])
            .build())
    defaults = {mlp.stepSize: 1e-3, mlp.layers: [64, 32, 10], mlp.maxIter: 30}

    def ev(models, v):
        return MD.evaluate_all(models, v, 50, key="Id", label="Genre", features="embedding", digits=6)

    return TU.random_search(mlp, grid, train, val, k=k, seed=SEED, evaluate_all=ev, defaults=defaults, parallelism=2)


def best_search_run(spark, sf, k: int = 3):
    return TU.best_run(random_search(spark, sf, k), "val_accuracy")


def _part_naive_bayes(spark, sf):
    """Multinomial naive Bayes on the part names of the training split: its
    fit is a closed form over counts, which SQL repeats exactly."""
    data = S.split_exact(_part_titles(spark, sf), "Id", 0.9, SEED)
    model = MD.fit_naive_bayes(data.where("split = 'train'"), text="Title", label="Genre")
    scored = MD.score(model, data.where("split = 'validation'"), keep=["Id", "Genre"])
    # rounded so that the last bits of two engines can't break a tie differently
    return scored.select("Id", "Genre", F.transform("z", lambda x: F.round(x, 9)).alias("z"))


def naive_bayes_titles(spark, sf):
    """Validation titles with their most likely class and its log score."""
    s = _part_naive_bayes(spark, sf)
    return s.select("Id", "Genre", argmax("z").alias("pred"), F.round(F.array_max("z"), 6).alias("log_score"))


def naive_bayes_per_class(spark, sf):
    """Per-class accuracy of those predictions, the truth joined by key."""
    from titleflow.operators.metrics import per_class_accuracy, with_truth
    s = _part_naive_bayes(spark, sf)
    joined = with_truth(s.select("Id", argmax("z").alias("pred")), _part_titles(spark, sf))
    return per_class_accuracy(joined, 6, digits=6)


def _doc_titles(spark, sf):
    d = spread(read_table(spark, sf, "documents").select(F.col("doc_id").alias("Id"),
                                                         F.col("text").alias("Title")), "Id")
    y = read_table(spark, sf, "labels").select(
        F.col("doc_id").alias("Id"), (F.col("quality") * 2 + F.col("toxic")).cast("int").alias("Genre"))
    return d, y


def _fit_documents(spark, sf):
    """Train on the labelled documents (90% by an exact seeded split)."""
    from titleflow.operators.joins import align_labels
    d, y = _doc_titles(spark, sf)
    labelled = align_labels(d, y, on="Id", how="inner", check="unique")
    data = S.split_exact(labelled, "Id", 0.9, SEED)
    train = data.where(F.col("split") == "train")
    val = data.where(F.col("split") == "validation")
    model = MD.fit_title(train, text="Title", label="Genre")
    return model, val, d, y


def title_submission(spark, sf):
    """Train on labelled titles, score the unlabelled ones and number the
    rows as the submission file does (Id = position in key order)."""
    model, _, d, y = _fit_documents(spark, sf)
    unlabelled = d.join(y.select("Id"), "Id", "left_anti")
    scored = MD.score(model, unlabelled, keep=["Id"])
    pos = S.with_position(scored.select("Id", F.col("pred").alias("Genre")), "Id", out="pos",
                          materialize=True)
    return pos.select(F.col("pos").alias("Id"), "Genre")


def title_validation(spark, sf):
    """Validation metrics of the document title model (batch size 50)."""
    model, val, _, _ = _fit_documents(spark, sf)
    return MD.evaluate(model, val.select("Id", "Title", "Genre"), 50, key="Id", label="Genre", digits=6)


def _document_vectors(spark, sf, docs, corpus):
    """Mean token vector per title of ``docs``: basic tokens, first 15
    kept, vectors from the ``corpus`` vocabulary ranked by frequency paired
    with ``embeddings`` rows (the stand-in for pretrained token vectors)."""
    from titleflow.functions.text import tokenize_basic
    from titleflow.operators import text as X
    corpus_toks = corpus.select("Id", tokenize_basic("Title").alias("tokens"))
    vocab = X.build_vocab(corpus_toks, "tokens", n_specials=0).select(
        "token", F.col("id").cast("long").alias("rank"))
    vectors = X.token_vectors_from_vocab(vocab, read_table(spark, sf, "embeddings"))
    toks = docs.select("Id", tokenize_basic("Title", first=15).alias("tokens"))
    emb = X.embed_tokens(toks, "tokens", vectors, 64, key="Id", length=15)
    return emb.select("Id", X.matrix_features("embedded", 64, "mean").alias("vec"))


def _title_vector_split(spark, sf):
    """Labelled titles as mean vectors, split 90/10. The vectors (64
    floats per title) are written once to the checkpoint folder: the key
    checks, the split's passes, the fit and the scoring then read that
    compact table instead of re-running vocabulary and lookups."""
    from titleflow.operators.joins import align_labels
    d, y = _doc_titles(spark, sf)
    labelled = align_labels(d, y, on="Id", how="inner", check="unique")
    vecs = _document_vectors(spark, sf, labelled.select("Id", "Title"), d)
    table = cut_lineage(vecs.join(labelled.select("Id", "Genre"), "Id"))
    data = S.split_exact(table, "Id", 0.9, SEED)
    return (data.where(F.col("split") == "train").drop("split"),
            data.where(F.col("split") == "validation").drop("split"))


def score_title_vectors_model(spark, sf):
    """Token vectors -> mean title vector -> MLP (the recurrent title
    model's data path), scored on the validation titles."""
    train, val = _title_vector_split(spark, sf)
    model = MD.fit_vectors(train, "vec", [64, 32, 4], label="Genre", seed=SEED)
    return MD.score(model, val, features="vec", keep=["Id", "Genre"]).select("Id", "Genre", "pred")


def ensemble_title_models(spark, sf):
    """Two title models - TF-IDF logistic regression and the token-vector
    MLP - scored on the same validation titles, combined by the product of
    their raw outputs, per-class accuracy (the two-model ensemble flow)."""
    from titleflow.operators.metrics import per_class_accuracy, with_truth
    model_a, val_a, _, y = _fit_documents(spark, sf)
    a = MD.score(model_a, val_a.select("Id", "Title"), keep=["Id"])
    train_b, val_b = _title_vector_split(spark, sf)
    model_b = MD.fit_vectors(train_b, "vec", [64, 32, 4], label="Genre", seed=SEED)
    b = MD.score(model_b, val_b, features="vec", keep=["Id"])
    ens = MD.ensemble(a, b, on="Id", mode="raw")
    return per_class_accuracy(with_truth(ens.select("Id", "pred"), y), 4, digits=6)


def registry():
    return {
        "score_title_model": score_title_model,
        "score_vector_model": score_vector_model,
        "evaluate_vector_model": evaluate_vector_model,
        "epoch_training": epoch_training,
        "random_search": random_search,
        "best_search_run": best_search_run,
        "naive_bayes_titles": naive_bayes_titles,
        "naive_bayes_per_class": naive_bayes_per_class,
        "title_submission": title_submission,
        "title_validation": title_validation,
        "score_title_vectors_model": score_title_vectors_model,
        "ensemble_title_models": ensemble_title_models,
    }
