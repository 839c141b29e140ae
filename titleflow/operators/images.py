"""Cover images.

Decoding is Spark's ``image`` source (executor-side). Pixel arithmetic
that needs a whole image at once - scaling, channel-first reordering,
per-image standardisation, block pooling - runs in Arrow-batched pandas
UDFs with NumPy inside; every image is independent, so the work is spread
over the partitions of the image table.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _basename(path_col):
    return F.element_at(F.split(path_col, "/"), -1)


def attach_images(df: DataFrame, images: DataFrame, *, cover: str = "Cover",
                  image: str = "image") -> DataFrame:
    """Left-join each row to its image by file name (the reference opens
    ``root + name``). Rows whose file is missing keep NULL image columns
    and ``has_image = false`` instead of failing the job.

    ``images`` is the ``image`` source output, or anything derived from it
    that still has the ``image.origin`` path - e.g. already normalised and
    pooled features. Normalising and pooling *before* attaching is the
    cheaper order at scale: the join then shuffles a few kilobytes of
    features per image instead of the raw pixel bytes.
    """
    from titleflow.operators.joins import lookup_join
    imgs = (images.withColumn("__tf_file", _basename(F.col(f"{image}.origin")))
            .withColumn("__tf_has", F.lit(True)))
    # Many titles can share one cover file (a placeholder image): the
    # titles side may be skewed on the file name, so the join splits hot
    # file names instead of sending them to one task.
    out = lookup_join(df.withColumn("__tf_file", F.col(cover)), imgs, "__tf_file", how="left",
                      allow_broadcast=False, salt_by=[c for c in df.columns])
    return (out.withColumn("has_image", F.col("__tf_has").isNotNull())
            .drop("__tf_file", "__tf_has"))


def check_shape(df: DataFrame, h: int = 224, w: int = 224, c: int = 3, *,
                image: str = "image", out: str = "shape_ok") -> DataFrame:
    """Flag rows whose image is decodable and has the expected shape
    (undecodable files have height -1)."""
    return df.withColumn(out, F.coalesce(
        (F.col(f"{image}.height") == h) & (F.col(f"{image}.width") == w)
        & (F.col(f"{image}.nChannels") == c), F.lit(False)))


def _to_chw(data: bytes, h: int, w: int, c: int) -> np.ndarray:
    a = np.frombuffer(data, dtype=np.uint8, count=h * w * c).reshape(h, w, c)
    return a.astype(np.float64).transpose(2, 0, 1) / 255.0


@F.pandas_udf(T.StructType([T.StructField("pixels", T.ArrayType(T.FloatType())),
                            T.StructField("is_constant", T.BooleanType())]))
def _normalize_udf(data: pd.Series, h: pd.Series, w: pd.Series, c: pd.Series) -> pd.DataFrame:
    pixels, const = [], []
    for d, hh, ww, cc in zip(data, h, w, c):
        if d is None or hh is None or hh <= 0:
            pixels.append(None)
            const.append(None)
            continue
        x = _to_chw(d, int(hh), int(ww), int(cc))
        constant = x.size < 2 or bool(x.min() == x.max())
        if constant:
            # 0 / 0 in the reference: every value is NaN
            y = np.full(x.shape, np.nan)
        else:
            y = (x - x.mean()) / x.std(ddof=1)
        pixels.append(y.astype(np.float32).ravel())
        const.append(constant)
    return pd.DataFrame({"pixels": pixels, "is_constant": const})


def normalize(df: DataFrame, *, image: str = "image", out: str = "pixels",
              extra: Callable | None = None) -> DataFrame:
    """Scale bytes to [0, 1], reorder HWC -> CHW, then standardise each
    image by its own mean and sample standard deviation (n - 1).

    Output ``out`` is ``array<float>`` of length c*h*w (channel-major) and
    ``is_constant``; a constant image gives NaN, as 0/0 does in the
    reference. ``extra`` is an optional pandas UDF applied to ``out``
    afterwards (the reference's pluggable transform).
    """
    s = _normalize_udf(F.col(f"{image}.data"), F.col(f"{image}.height"),
                       F.col(f"{image}.width"), F.col(f"{image}.nChannels"))
    res = df.withColumn("__tf_norm", s)
    res = (res.withColumn(out, F.col("__tf_norm.pixels"))
           .withColumn("is_constant", F.col("__tf_norm.is_constant")).drop("__tf_norm"))
    if extra is not None:
        res = res.withColumn(out, extra(F.col(out)))
    return res


def pool(df: DataFrame, h: int, w: int, c: int = 3, *, block: int = 14,
         pixels: str = "pixels", out: str = "pooled") -> DataFrame:
    """Block-mean pooling of a channel-major pixel array: ``c x h x w`` ->
    ``c x ceil(h/block) x ceil(w/block)`` (edge blocks average what they
    hold). Small fixed-size features for the image classifier."""
    hb, wb = -(-h // block), -(-w // block)

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def _pool(col: pd.Series) -> pd.Series:
        res = []
        for a in col:
            if a is None:
                res.append(None)
                continue
            x = np.asarray(a, dtype=np.float64).reshape(c, h, w)
            pad = np.full((c, hb * block, wb * block), np.nan)
            pad[:, :h, :w] = x
            m = np.nanmean(pad.reshape(c, hb, block, wb, block), axis=(2, 4))
            res.append(m.astype(np.float32).ravel())
        return pd.Series(res)

    return df.withColumn(out, _pool(F.col(pixels)))
