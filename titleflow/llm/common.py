"""Helpers shared by the operators: word splitting as native expressions,
let-bindings, stored intermediate tables and hidden column names."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from titleflow.session import ensure_checkpoint_dir

#: ASCII white space: what separates words in every contract but the licences'.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    An expression that a lambda refers to would otherwise be evaluated for
    every element; bound as a lambda variable it is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """Words (runs without ASCII white space) of a text; null: no words."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z only; other letters keep their case."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def total(values: Column) -> Column:
    """Sum of an array of integers as long; empty: 0."""
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def row_key(df: DataFrame) -> list[Column]:
    """128 bits over all columns of a row: two independent 64-bit hashes.

    Two rows agree in both exactly when they are equal in every column (up
    to a chance of about n^2 / 2^129), so rows with null or repeated ids
    can still be told apart.
    """
    cols = [F.col(f"`{c}`") for c in df.columns]
    flags = F.concat_ws("", *[F.isnull(c).cast("int").cast("string") for c in cols])
    return [F.xxhash64(F.lit(1), flags, *cols).alias("__h1"), F.xxhash64(F.lit(2), flags, *cols).alias("__h2")]


def folder(spark: SparkSession) -> str:
    """A new path below the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` once as Parquet below ``spark.checkpoint.dir`` and read
    it back: the lineage ends there, and a lost executor costs a reread."""
    path = folder(df.sparkSession)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the files of a :func:`stored` table that nothing reads any more."""
    path = getattr(df, "_stored_at", None)
    if path:
        jvm = df.sparkSession._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)
