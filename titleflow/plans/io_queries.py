"""Registered queries through files and images (SURVEY S1-S4, S6-S9, S11,
J2, J5, P4-P6, R5, R8, R12, R13, A10).

Each writes a given table in the layout that a reader of the library
expects, below ``spark.checkpoint.dir``, and reads it back with that reader;
a sink writes and its files are read. Images are made of the components of
``embeddings`` (4 x 4 pixels of 4 channels a vector).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from titleflow.functions.arrays import argmax
from titleflow.functions.text import tokenize_basic
from titleflow.operators import images as I
from titleflow.operators import metrics as M
from titleflow.operators import models as MD
from titleflow.operators import text as X
from titleflow.plans import queries as Q
from titleflow.session import ensure_checkpoint_dir
from titleflow.sources import tables as S


def _path(spark) -> str:
    return f"{ensure_checkpoint_dir(spark)}/io-{uuid.uuid4().hex}"


def _csv(df: DataFrame) -> str:
    """``df`` as CSV files with a header, quotes doubled and blanks kept."""
    path = _path(df.sparkSession)
    df.write.option("header", True).option("escape", '"').option("quoteAll", True).option(
        "ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option("emptyValue", "").csv(path)
    return path


def _feature_file(spark, sf) -> str:
    titles = Q._titles(spark, sf)
    return _csv(titles.select("Id", F.concat(F.col("Id").cast("string"), F.lit(".png")).alias("Cover"), "Title"))


def feature_file(spark, sf):
    """The feature CSV read with its schema, header check and multi-line titles."""
    rows = S.read_features(spark, _feature_file(spark, sf))
    return rows.select("Id", "Cover", F.md5(F.col("Title").cast("binary")).alias("title_md5"),
                       F.char_length("Title").alias("n_chars"))


def feature_file_by_position(spark, sf):
    """The same file under other header names, its columns taken by ordinal."""
    titles = Q._titles(spark, sf).select(F.col("Id").alias("no"), F.concat(F.lit("c"), F.col("Id") % 97).alias("picture"), "Title")
    rows = S.read_features(spark, _csv(titles), columns=["Id", "Image", "Title"], check_header=False)
    return rows.select("Id", F.col(rows.columns[1]).alias("image"), F.md5(F.col("Title").cast("binary")).alias("title_md5"))


def labelled_files(spark, sf):
    """Feature and label CSV joined by key, label range checked."""
    labels = _csv(Q._labels(spark, sf).select("Id", "Genre"))
    S.read_labels(spark, labels, 4, check=True)
    rows = S.read_labelled(spark, _feature_file(spark, sf), labels, check="unique", n_classes=4)
    return rows.select("Id", "Genre", F.md5(F.col("Title").cast("binary")).alias("title_md5"))


def submission_file(spark, sf):
    """The submission CSV of the argmax predictions, ids by position, read back."""
    path = _path(spark)
    S.write_submission(Q._outputs(spark, sf).select("Id", argmax("z").alias("Genre")), path, id_mode="position")
    return S.read_labels(spark, path, None)


def metric_log_file(spark, sf):
    """The metric log written twice as a retried job would, read back as epochs."""
    path, log = _path(spark), Q._metric_log(spark, sf).withColumn("run_id", F.lit("events"))
    S.replace_metrics(log, path)
    S.replace_metrics(log, path)
    return M.epoch_history(S.read_metrics(spark, path), Q.HISTORY, digits=Q.DIGITS)


def token_vector_file(spark, sf):
    """A file of tokens with their vectors, one a line."""
    path = _path(spark)
    vectors = S.read_table(spark, sf, "embeddings").select(F.concat_ws(
        " ", F.concat(F.lit("w"), F.col("vec_id")), F.array_join(F.col("embedding").cast("array<string>"), " ")).alias("value"))
    vectors.write.text(path)
    rows = S.read_token_vectors(spark, path, 64)
    total = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return rows.select("token", F.size("vector").alias("dim"), F.round(total, Q.DIGITS).alias("vec_sum"))


def vocabulary_file(spark, sf):
    """The part names' vocabulary as one file, numbered by its lines."""
    path = _path(spark)
    names = S.read_table(spark, sf, "part").select(tokenize_basic("p_name").alias("tokens"))
    X.build_vocab(names, "tokens", n_specials=0).repartition(1).sortWithinPartitions("id").select("token").write.text(path)
    return S.read_vocab(spark, path)


def ensemble_join(spark, sf):
    """Two score tables joined by key, combined by product."""
    out = Q._outputs(spark, sf)
    both = MD.ensemble(out.select("Id", "z"), out.select("Id", F.col("z_b").alias("z")), on="Id", mode="raw")
    return both.select("Id", "pred_a", "pred_b", "pred")


def encode_titles_pad_end(spark, sf):
    """Encoded titles whose padding is the end-of-text id."""
    enc = X.encode(Q._basic_tokens(spark, sf), "tokens", Q._vocab(spark, sf), key="Id", max_len=Q.MAX_LEN, pad_id=2)
    return enc.select("Id", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
                      F.aggregate("attention_mask", F.lit(0), lambda a, x: a + x).alias("n_mask"))


def stored_positions(spark, sf):
    """Orders stored by position, fetched at the numbers that the parts name."""
    from titleflow.operators.position_store import fetch_positions, store_positions
    orders = S.read_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    path = _path(spark)
    store_positions(orders, path, "o_orderkey", bucket_rows=1000)
    wanted = S.read_table(spark, sf, "part").select((F.col("p_partkey") * 7).alias("pos"))
    return fetch_positions(spark, path, wanted).select("pos", F.col("o_orderkey").alias("Id"), "o_custkey")


def _images(spark, sf) -> DataFrame:
    """The rows of the ``image`` source, one made of each vector's components."""
    byte = F.transform("embedding", lambda x: F.least(F.lit(255), F.greatest(F.lit(0), F.floor(128 + 256 * x.cast("double")))))
    data = F.unhex(F.array_join(F.transform(byte, lambda b: F.lpad(F.hex(b), 2, "0")), ""))
    e = S.read_table(spark, sf, "embeddings")
    return e.select(F.struct(F.concat(F.lit("file:/images/"), F.col("vec_id"), F.lit(".png")).alias("origin"),
                             F.lit(4).alias("height"), F.lit(4).alias("width"), F.lit(4).alias("nChannels"),
                             F.lit(28).alias("mode"), data.alias("data")).alias("image"))


def cover_images(spark, sf):
    """Titles with their cover by file name, its shape checked, its pixels
    scaled, reordered to channels first and standardised."""
    titles = Q._titles(spark, sf).select("Id", F.concat(F.col("Id").cast("string"), F.lit(".png")).alias("Cover"))
    rows = I.check_shape(I.attach_images(titles, _images(spark, sf)), 4, 4, 4)
    rows = I.normalize(rows)
    weighted = F.aggregate(F.transform("pixels", lambda x, i: (i + 1) * x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return rows.select("Id", "has_image", "shape_ok", "is_constant", F.round(weighted, 4).alias("weighted"))


def registry():
    return {f.__name__: f for f in (feature_file, feature_file_by_position, labelled_files, submission_file, metric_log_file,
                                    token_vector_file, vocabulary_file, ensemble_join, encode_titles_pad_end, stored_positions, cover_images)}
