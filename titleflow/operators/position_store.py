"""A stored position index: fetch rows by number without
ranking the table again.

:func:`store_positions` numbers the rows once and writes them in folders of
``bucket_rows`` consecutive positions, so that a position names its folder:
``position div bucket_rows``. :func:`fetch_positions` reads the folders of
the wanted positions only (partition pruning) and joins those rows. The
table of wanted positions may be large; its distinct folders are counted
before any of them is listed, above ``MAX_FOLDERS`` of them the join reads
everything once.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from titleflow.operators.sampling import with_position

_BUCKET, _POS = "__tf_folder", "__tf_position"
#: Folders that a fetch lists in its plan; more are not pruned.
MAX_FOLDERS = 10_000


def store_positions(df: DataFrame, path: str, order_by: Column | str, *, seed=None, bucket_rows: int = 100_000) -> None:
    """Write ``df`` in the order of ``order_by`` (or the md5 order of ``seed``)
    with its positions below ``path``, ``bucket_rows`` rows a folder.

    One folder is written by one task and sorted, so a fetch also skips row
    groups. An existing store is replaced; an empty table stores no folder.
    """
    if bucket_rows <= 0:
        raise ValueError("bucket_rows must be positive")
    placed = with_position(df, order_by, seed=seed, out=_POS, materialize=True)
    placed = placed.withColumn(_BUCKET, F.expr(f"{_POS} div {int(bucket_rows)}"))
    placed = placed.repartition(_BUCKET).sortWithinPartitions(_BUCKET, _POS)
    placed.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(_BUCKET).parquet(path)
    spark = df.sparkSession
    spark.createDataFrame([(int(bucket_rows), placed.schema.json())], "bucket_rows long, schema string").coalesce(1).write.mode(
        "overwrite").json(f"{path.rstrip('/')}-index")


def fetch_positions(spark: SparkSession, path: str, positions: Sequence[int] | DataFrame, *, out: str = "pos") -> DataFrame:
    """The stored rows at the wanted 0-based ``positions`` (a list, or a table
    whose first column holds them), with their position as ``out``.

    A position that is wanted twice gives its row twice; NULLs and positions
    beyond the table give none.
    """
    index = spark.read.schema("bucket_rows long, schema string").json(f"{path.rstrip('/')}-index").first()
    schema = StructType.fromJson(json.loads(index["schema"]))
    if not isinstance(positions, DataFrame):
        positions = spark.createDataFrame([(int(p),) for p in positions], "p long")
    wanted = positions.select(F.col(positions.columns[0]).cast("long").alias(_POS)).where(f"{_POS} >= 0")
    folder = F.expr(f"{_POS} div {index['bucket_rows']}")
    folders = [r[0] for r in wanted.select(folder.alias("f")).distinct().limit(MAX_FOLDERS + 1).collect()]
    rows = spark.read.schema(schema).parquet(path)
    if len(folders) <= MAX_FOLDERS:
        rows = rows.where(F.col(_BUCKET).isin(folders) if folders else F.lit(False))
    found = rows.join(wanted.withColumn(_BUCKET, folder), [_BUCKET, _POS])
    return found.select(*[F.col(f"`{f.name}`") for f in schema.fields if f.name not in (_BUCKET, _POS, out)],
                        F.col(_POS).alias(out))
