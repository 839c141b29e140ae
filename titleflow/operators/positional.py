"""Rows by their place in the files (SURVEY J1 ``on='position'``, O4, O6).

A dataset of the reference pairs the i-th line of one file with the i-th
line of another. A Spark scan has no such number, but every row knows its
file and where it stands there:

* Parquet: ``_metadata.row_index`` is the row's number inside its file;
* line files (CSV, text, JSON): ``_metadata.file_block_start`` names the
  split, and ``monotonically_increasing_id`` counts the rows of a split
  without a gap as long as nothing stands between it and the scan.

One aggregate per file (or split) gives their sizes; prefix sums over that
small table, files in the order of their paths, are the offsets. So the
numbers need no sort and no shuffle of the rows.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from titleflow.operators.joins import KeyCheckError

_FILE, _BLOCK, _AT = "__tf_file", "__tf_block", "__tf_at"
#: Offsets of at most this many files or splits are broadcast.
FEW_PARTS = 100_000


def _located(df: DataFrame) -> DataFrame:
    """``df`` with file, split and the place inside it."""
    try:
        place = df.select("*", F.col("_metadata.file_path").alias(_FILE), F.lit(0).cast("long").alias(_BLOCK),
                          F.col("_metadata.row_index").alias(_AT))
        place.schema  # noqa: B018 - the analysis finds out whether the source numbers its rows
        return place
    except AnalysisException:
        pass
    try:
        return df.select("*", F.col("_metadata.file_path").alias(_FILE), F.col("_metadata.file_block_start").alias(_BLOCK),
                         F.monotonically_increasing_id().alias(_AT))
    except AnalysisException as e:
        raise ValueError("row positions need a table as its file reader returned it (select columns afterwards)") from e


def _offsets(located: DataFrame) -> DataFrame:
    """(file, block, offset - first place, end): one row per file or split."""
    parts = located.groupBy(_FILE, _BLOCK).agg(F.min(_AT).alias("__tf_first"), F.count(F.lit(1)).alias("__tf_n"))
    upto = Window.orderBy(_FILE, _BLOCK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum("__tf_n").over(upto)  # one row per file or split, not per row
    return parts.select(_FILE, _BLOCK, (end - F.col("__tf_n") - F.col("__tf_first")).alias("__tf_shift"), end.alias("__tf_end"))


def _numbered(df: DataFrame, out: str) -> tuple[DataFrame, int]:
    from titleflow.session import cut_lineage
    located = _located(df)
    offsets = cut_lineage(_offsets(located))
    parts, rows = offsets.agg(F.count(F.lit(1)), F.max("__tf_end")).first()
    side = F.broadcast(offsets) if parts <= FEW_PARTS else offsets
    numbered = located.join(side, [_FILE, _BLOCK]).withColumn(out, F.col(_AT) + F.col("__tf_shift"))
    return numbered.drop(_FILE, _BLOCK, _AT, "__tf_shift", "__tf_end"), rows or 0


def with_file_position(df: DataFrame, out: str = "pos") -> DataFrame:
    """``df``, as a file reader returned it, with ``out``: 0-based number of
    the row in the order of paths and of rows inside each file.

    Rows are numbered whatever they hold (nulls, repeats); an empty table
    stays empty; a column named ``out`` gives way to the number.
    """
    return _numbered(df.drop(out) if out in df.columns else df, out)[0]


def pair_by_position(x: DataFrame, y: DataFrame, *, lengths: str = "equal", pos: str = "pos",
                     prefix: str = "y_") -> DataFrame:
    """Row i of ``x`` next to row i of ``y`` with their number ``pos``.

    Both are tables as their file readers returned them. Tables of unequal
    length raise :class:`KeyCheckError` (``lengths='equal'``), end where the
    shorter one ends (``'shortest'``, as zip does) or leave the missing side
    NULL (``'longest'``). Columns of ``y`` whose names ``x`` has too get
    ``prefix``. One shuffle of either table by ``pos``.
    """
    how = {"equal": "inner", "shortest": "inner", "longest": "full"}.get(lengths)
    if how is None:
        raise ValueError("lengths must be 'equal', 'shortest' or 'longest'")
    (x, nx), (y, ny) = (_numbered(d.drop(pos) if pos in d.columns else d, pos) for d in (x, y))
    if lengths == "equal" and nx != ny:
        raise KeyCheckError(f"{nx} rows cannot be paired with {ny}")
    both = {c: f"{prefix}{c}" for c in y.columns if c != pos and c in x.columns}
    return x.join(y.withColumnsRenamed(both), on=pos, how=how)
