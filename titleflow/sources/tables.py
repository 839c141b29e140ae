"""CSV / text / Parquet readers and sinks.

Schemas are always explicit (no ``inferSchema``). CSV titles contain
commas and doubled quotes, so the readers use ``escape='"'``; a header
that does not match the schema and a malformed number both fail the read
instead of producing NULLs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FEATURES_SCHEMA = T.StructType([
    T.StructField("Id", T.LongType(), False),
    T.StructField("Cover", T.StringType(), True),
    T.StructField("Title", T.StringType(), True),
])

LABELS_SCHEMA = T.StructType([
    T.StructField("Id", T.LongType(), False),
    T.StructField("Genre", T.IntegerType(), True),
])

SUBMISSION_SCHEMA = LABELS_SCHEMA

METRIC_LOG_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType(), False),
    T.StructField("epoch", T.IntegerType(), True),
    T.StructField("step", T.LongType(), True),
    T.StructField("metric", T.StringType(), False),
    T.StructField("value", T.DoubleType(), True),
])


def _csv(spark: SparkSession, schema: T.StructType, multiline: bool, check_header: bool = True):
    return (spark.read.schema(schema)
            .option("header", True)
            .option("escape", '"')
            .option("multiLine", multiline)
            .option("enforceSchema", not check_header)
            .option("mode", "FAILFAST"))


def features_schema(columns) -> T.StructType:
    """Schema for a feature file whose header is ``columns``: the first
    column is the long ``Id``, the rest are strings (the image file name
    sits at ordinal 1 whatever its header calls it)."""
    columns = list(columns)
    return T.StructType([T.StructField(columns[0], T.LongType(), False)]
                        + [T.StructField(c, T.StringType(), True) for c in columns[1:]])


def read_features(spark: SparkSession, path: str, schema: T.StructType = FEATURES_SCHEMA,
                  *, columns=None, multiline: bool = True, check_header: bool = True) -> DataFrame:
    """Feature table ``Id, Cover, Title``. A title read as NULL (empty
    field) becomes ``''``; texts such as ``NA`` stay text. ``multiLine``
    (a quoted title may hold a line break) reads each file in one task,
    so big inputs should come as many files or be converted to Parquet.

    ``columns`` gives the header names when they differ from ours (the
    reference reads the cover file name by position); with
    ``check_header=False`` columns are taken by position and the header
    names are ignored.
    """
    if columns is not None:
        schema = features_schema(columns)
    df = _csv(spark, schema, multiline, check_header).csv(path)
    if "Title" in df.columns:
        df = df.withColumn("Title", F.coalesce(F.col("Title"), F.lit("")))
    return df


def read_labels(spark: SparkSession, path: str, n_classes: int | None = 30, *,
                check: bool = False) -> DataFrame:
    """Label table ``Id, Genre``; with ``check`` a label outside
    ``0..n_classes-1`` raises (a distributed count, nothing collected)."""
    df = _csv(spark, LABELS_SCHEMA, False).csv(path)
    if check and n_classes is not None:
        bad = df.where(F.col("Genre").isNull() | (F.col("Genre") < 0)
                       | (F.col("Genre") >= n_classes)).limit(1).count()
        if bad:
            raise ValueError(f"label outside 0..{n_classes - 1}")
    return df


def read_labelled(spark: SparkSession, x_path: str, y_path: str, *, check: bool | str = True,
                  n_classes: int | None = 30) -> DataFrame:
    """Features joined to their labels by ``Id`` (held-out pair scan)."""
    from titleflow.operators.joins import align_labels
    return align_labels(read_features(spark, x_path), read_labels(spark, y_path, n_classes),
                        on="Id", how="inner", check=check)


def without_labels(df: DataFrame, label: str = "Genre") -> DataFrame:
    """Unlabelled rows with a NULL label column, so that labelled and
    unlabelled tables share one schema (replaces the placeholder-label
    file)."""
    return df.withColumn(label, F.lit(None).cast("int"))


def read_token_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """Whitespace-separated ``token v1 .. v_dim`` text file (GloVe layout) ->
    ``token string, vector array<float>``.

    The last ``dim`` fields are the vector and what stands before them is
    the token, which may hold blanks itself; blanks around a line and empty
    lines are ignored. A line with fewer fields fails the read, as does a
    field that is no number.
    """
    raw = spark.read.text(path).select(F.trim("value").alias("value")).where("value <> ''")
    parts = raw.select("value", F.split("value", " ").alias("p"))
    n = F.size("p") - dim
    fits = F.when(n >= 1, n).otherwise(
        F.raise_error(F.concat(F.lit(f"no token with {dim} values: "), F.substring("value", 1, 80))).cast("int"))
    return parts.withColumn("n", fits).select(
        F.array_join(F.slice("p", F.lit(1), F.col("n")), " ").alias("token"),
        F.slice("p", F.col("n") + 1, F.lit(dim)).cast("array<float>").alias("vector"))


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """Vocabulary file with one token per line; id = 0-based line number.

    ``monotonically_increasing_id`` grows with the file offset inside a
    split and across the ordered splits of a file, so ranking it with the
    distributed position index gives the line number without a driver
    pass or a single-task window. Several files have no common line
    numbers (a scan orders them by size), so they are refused.
    """
    from titleflow.operators.sampling import with_position
    lines = spark.read.text(path)
    if len(lines.inputFiles()) > 1:
        raise ValueError("a vocabulary is one file: line numbers of several files are undefined")
    raw = lines.select(F.col("value").alias("token"), F.monotonically_increasing_id().alias("__tf_line"))
    return (with_position(raw, "__tf_line", out="id")
            .select("token", F.col("id").cast("int").alias("id")))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def write_submission(df: DataFrame, path: str, *, id_col: str = "Id", genre: str = "Genre",
                     id_mode: str = "id", order_by: str | None = None,
                     single_file: bool = False, mode: str = "overwrite") -> None:
    """Write the ``Id,Genre`` submission CSV with a header.

    ``id_mode='position'`` writes the row position (0..n-1 in ``order_by``
    order) instead of the table's own key, as the reference's output does.
    ``single_file`` funnels the (two small columns of the) result through
    one writer task; leave it off for large outputs.
    """
    out = df
    if id_mode == "position":
        from titleflow.operators.sampling import with_position
        out = with_position(df.select(id_col, genre), order_by or id_col, out="__tf_pos",
                            materialize=True).withColumn(id_col, F.col("__tf_pos"))
    elif id_mode != "id":
        raise ValueError("id_mode must be 'id' or 'position'")
    out = out.select(F.col(id_col).cast("long").alias("Id"), F.col(genre).cast("int").alias("Genre"))
    if single_file:
        # a shuffle of the two narrow columns: coalesce(1) would pull the
        # scoring itself into the one writer task
        out = out.repartition(1).sortWithinPartitions("Id")
    else:
        out = out.sortWithinPartitions("Id")
    out.write.mode(mode).option("header", True).csv(path)


def append_metrics(df: DataFrame, path: str) -> None:
    """Append rows in the metric-log shape to a Parquet log (replaces the
    experiment-tracking service)."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in METRIC_LOG_SCHEMA.fields]
    df.select(*cols).write.mode("append").parquet(path)


def replace_metrics(df: DataFrame, path: str) -> None:
    """Write rows in the metric-log shape so that a repeated write changes
    nothing: the log is partitioned by run and epoch, and the partitions
    that ``df`` holds are replaced as a whole (dynamic overwrite). Others
    stay. Write all metrics of a run's epoch together."""
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in METRIC_LOG_SCHEMA.fields]
    df.select(*cols).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "run_id", "epoch").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """A log of :func:`append_metrics` or :func:`replace_metrics`."""
    rows = spark.read.schema(METRIC_LOG_SCHEMA).parquet(path)
    return rows.select(*METRIC_LOG_SCHEMA.names)
