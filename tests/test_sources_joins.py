import os

import pytest

from titleflow.operators.joins import KeyCheckError, align_labels
from titleflow.sources import (read_features, read_labelled, read_labels, read_token_vectors,
                               read_vocab, without_labels, write_submission)

X_CSV = 'Id,Cover,Title\n0,a.bmp,"It\'s a Test, (really)!"\n1,b.bmp,"a ""q"", b"\n2,missing.bmp,\n3,a.bmp,Ünïcode: Straße; NA\n'
Y_CSV = "Id,Genre\n0,0\n1,1\n2,1\n3,2\n"


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_feature_csv_round_trip(spark, tmpdir_path):
    x = read_features(spark, _write(tmpdir_path, "x.csv", X_CSV))
    got = {r.Id: (r.Cover, r.Title) for r in x.collect()}
    assert got == {0: ("a.bmp", "It's a Test, (really)!"), 1: ("b.bmp", 'a "q", b'),
                   2: ("missing.bmp", ""), 3: ("a.bmp", "Ünïcode: Straße; NA")}


def test_csv_strictness(spark, tmpdir_path):
    bad_int = _write(tmpdir_path, "y_bad.csv", "Id,Genre\n0,zero\n")
    with pytest.raises(Exception):
        read_labels(spark, bad_int).collect()
    bad_header = _write(tmpdir_path, "y_hdr.csv", "Key,Class\n0,1\n")
    with pytest.raises(Exception):
        read_labels(spark, bad_header).collect()
    out_of_range = _write(tmpdir_path, "y_rng.csv", "Id,Genre\n0,31\n")
    with pytest.raises(ValueError):
        read_labels(spark, out_of_range, 30, check=True)


def test_read_labelled_and_key_checks(spark, tmpdir_path):
    xp = _write(tmpdir_path, "x.csv", X_CSV)
    yp = _write(tmpdir_path, "y.csv", Y_CSV)
    j = read_labelled(spark, xp, yp)
    assert sorted((r.Id, r.Genre) for r in j.collect()) == [(0, 0), (1, 1), (2, 1), (3, 2)]
    x = read_features(spark, xp)
    for bad in ("Id,Genre\n0,0\n1,1\n2,1\n",            # missing
                "Id,Genre\n0,0\n1,1\n2,1\n3,2\n4,0\n",  # extra
                "Id,Genre\n0,0\n1,1\n2,1\n3,2\n3,1\n"):  # duplicate
        y = read_labels(spark, _write(tmpdir_path, "yb.csv", bad))
        with pytest.raises(KeyCheckError):
            align_labels(x, y, check=True)
    y = read_labels(spark, _write(tmpdir_path, "y3.csv", "Id,Genre\n0,0\n1,1\n"))
    left = align_labels(x, y, how="left", check="unique")
    assert sorted((r.Id, r.Genre) for r in left.collect()) == [(0, 0), (1, 1), (2, None), (3, None)]
    assert without_labels(x).schema["Genre"].dataType.simpleString() == "int"


def test_write_submission(spark, tmpdir_path):
    df = spark.createDataFrame([(30, 2), (10, 0), (20, 1)], "Id long, Genre int")
    out = os.path.join(tmpdir_path, "sub")
    write_submission(df, out, id_mode="position", order_by="Id", single_file=True)
    files = [f for f in os.listdir(out) if f.endswith(".csv")]
    assert len(files) == 1
    text = open(os.path.join(out, files[0])).read().splitlines()
    assert text == ["Id,Genre", "0,0", "1,1", "2,2"]


def test_token_vectors_and_vocab(spark, tmpdir_path):
    vp = _write(tmpdir_path, "vec.txt", "a 1 2\nb 3 4\n")
    v = {r.token: r.vector for r in read_token_vectors(spark, vp, 2).collect()}
    assert v == {"a": [1.0, 2.0], "b": [3.0, 4.0]}
    words = ["[PAD]", "[CLS]", "[SEP]", "[UNK]", "a", "test"]
    voc = read_vocab(spark, _write(tmpdir_path, "vocab.txt", "\n".join(words) + "\n"))
    assert {r.token: r.id for r in voc.collect()} == {w: i for i, w in enumerate(words)}


def test_feature_columns_by_position(spark, tmpdir_path):
    p = _write(tmpdir_path, "x2.csv", X_CSV.replace("Id,Cover,Title", "Id,Image,Title"))
    with pytest.raises(Exception):
        read_features(spark, p).collect()
    a = read_features(spark, p, columns=["Id", "Image", "Title"])
    assert a.columns == ["Id", "Image", "Title"] and a.count() == 4
    b = read_features(spark, p, check_header=False)
    assert b.columns == ["Id", "Cover", "Title"] and sorted(r.Cover for r in b.collect())[0] == "a.bmp"


def test_null_key_rejected(spark):
    x = spark.createDataFrame([(1, "a"), (None, "b")], "Id long, Title string")
    y = spark.createDataFrame([(1, 0)], "Id long, Genre int")
    with pytest.raises(KeyCheckError, match="NULL"):
        align_labels(x, y, check="unique")
