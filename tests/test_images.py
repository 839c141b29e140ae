import os
import struct

import numpy as np
from pyspark.sql import functions as F

from titleflow.operators.images import attach_images, check_shape, normalize, pool
from titleflow.sources import read_images


def _bmp(path, rows_bgr):
    """24-bit BMP; rows_bgr is a list of rows (top first) of (b, g, r)."""
    h, w = len(rows_bgr), len(rows_bgr[0])
    row_size = (3 * w + 3) // 4 * 4
    data = b""
    for row in reversed(rows_bgr):
        raw = b"".join(bytes(px) for px in row)
        data += raw + b"\0" * (row_size - len(raw))
    header = b"BM" + struct.pack("<IHHI", 54 + len(data), 0, 0, 54)
    info = struct.pack("<IiiHHIIiiII", 40, w, h, 1, 24, 0, len(data), 2835, 2835, 0, 0)
    with open(path, "wb") as f:
        f.write(header + info + data)


def _fixture_dir(d):
    _bmp(os.path.join(d, "a.bmp"), [[(1, 2, 3), (4, 5, 6)], [(7, 8, 9), (10, 11, 12)]])
    _bmp(os.path.join(d, "c.bmp"), [[(5, 5, 5), (5, 5, 5)], [(5, 5, 5), (5, 5, 5)]])
    with open(os.path.join(d, "junk.bmp"), "wb") as f:
        f.write(b"not an image")
    return d


def test_read_normalize_and_flags(spark, tmpdir_path):
    d = _fixture_dir(tmpdir_path)
    imgs = read_images(spark, d)
    titles = spark.createDataFrame([(0, "a.bmp"), (1, "c.bmp"), (2, "missing.bmp"), (3, "junk.bmp")],
                                   "Id long, Cover string")
    j = check_shape(attach_images(titles, imgs), 2, 2, 3)
    rows = {r.Id: r for r in j.collect()}
    assert rows[0].image.height == 2 and bytes(rows[0].image.data) == bytes(range(1, 13))
    assert rows[0].shape_ok and not rows[2].has_image and not rows[2].shape_ok
    assert rows[3].image.height == -1 and not rows[3].shape_ok
    n = normalize(j.where("shape_ok"))
    got = {r.Id: r for r in n.collect()}
    exp = [-1.5254, -0.6934, 0.1387, 0.9707, -1.2481, -0.4160, 0.4160, 1.2481,
           -0.9707, -0.1387, 0.6934, 1.5254]
    assert np.allclose(got[0].pixels, exp, atol=1e-4) and got[0].is_constant is False
    assert all(np.isnan(v) for v in got[1].pixels) and got[1].is_constant is True
    p = pool(n.where("Id = 0"), 2, 2, 3, block=2).first().pooled
    assert np.allclose(p, [np.mean(exp[0:4]), np.mean(exp[4:8]), np.mean(exp[8:12])], atol=1e-5)
    plan = n._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_image_classifier_on_pooled_features(spark, tmpdir_path):
    from titleflow.operators.models import fit_image, score
    rows = []
    for i in range(12):
        dark = i % 2 == 0
        base = 20 if dark else 200
        px = [[((base + 3 * i + r) % 256, (base + c) % 256, (base + r * c) % 256) for c in range(4)]
              for r in range(4)]
        if not dark:  # bright covers have a dark top-left block
            for r in range(2):
                for c in range(2):
                    px[r][c] = (5, 5, 5)
        name = f"img{i}.bmp"
        _bmp(os.path.join(tmpdir_path, name), px)
        rows.append((i, name, 0 if dark else 1))
    titles = spark.createDataFrame(rows, "Id long, Cover string, Genre int")
    feats = pool(normalize(read_images(spark, tmpdir_path)), 4, 4, 3, block=2)
    data = attach_images(titles, feats).where("has_image")
    model = fit_image(data, "pooled", max_iter=50)
    scored = score(model, data, features="pooled", keep=["Id", "Genre"])
    acc = scored.agg(F.avg((F.col("pred") == F.col("Genre")).cast("double"))).first()[0]
    assert scored.count() == 12 and acc == 1.0
