"""Streaming use of the stateless operators.

Tokenising, encoding-free scoring and argmax are per-row expressions, so
they apply unchanged to a streaming DataFrame: a directory of new feature
files can be scored as it fills, with an exactly-once file sink whose
progress lives in the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from titleflow.functions.text import tokenize_basic
from titleflow.sources.tables import FEATURES_SCHEMA
from titleflow.session import ensure_checkpoint_dir


def read_features_stream(spark: SparkSession, path: str, *, fmt: str = "csv",
                         max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of feature rows from files arriving in ``path`` (CSV with the
    feature schema, or Parquet)."""
    r = spark.readStream.schema(FEATURES_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        r = r.option("header", True).option("escape", '"').option("multiLine", True)
        return r.csv(path)
    return r.format(fmt).load(path)


def with_tokens(stream: DataFrame, title: str = "Title", out: str = "tokens") -> DataFrame:
    return stream.withColumn(out, tokenize_basic(title))


def predict_stream(model, stream: DataFrame) -> DataFrame:
    """Score a stream with a fitted title model; keeps ``Id`` and adds the
    predicted ``Genre``."""
    scored = model.transform(stream)
    return scored.select("Id", F.col("prediction").cast("int").alias("Genre"))


def write_predictions(pred: DataFrame, path: str, *, name: str = "titleflow_predictions",
                      checkpoint: str | None = None, trigger_once: bool = False
                      ) -> StreamingQuery:
    """Append predictions as CSV files (header ``Id,Genre``); progress is
    kept under ``spark.checkpoint.dir`` unless a location is given."""
    ck = checkpoint or f"{ensure_checkpoint_dir(pred.sparkSession).rstrip('/')}/{name}"
    w = (pred.writeStream.format("csv").option("header", True)
         .option("checkpointLocation", ck).option("path", path).outputMode("append"))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
