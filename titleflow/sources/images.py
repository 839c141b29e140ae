"""Image source: Spark's built-in ``image`` data source.

It decodes each file once on the executors into the struct ``image``
(origin, height, width, nChannels, mode, data) with the bytes row-wise in
BGR order. Undecodable files come back with height -1 unless
``drop_invalid``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_images(spark: SparkSession, path: str, *, drop_invalid: bool = False,
                recursive: bool = False) -> DataFrame:
    reader = spark.read.format("image").option("dropInvalid", drop_invalid)
    if recursive:
        reader = reader.option("recursiveFileLookup", True)
    return reader.load(path)
