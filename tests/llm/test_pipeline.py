import random

import corpus_pipeline as P
from titleflow.llm import lines as L


def corpus(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghijklm") for _ in range(r.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    item = prose(40)
    docs = [(i, "\n".join(prose(40) for _ in range(4))) for i in range(40)]
    docs.append((50, docs[0][1]))                                      # exact copy
    docs.append((51, "\n".join([prose(45), docs[1][1].split("\n")[0], prose(50)])))  # one repeated line
    near = prose(1200).split()
    docs.append((52, " ".join(near)))
    docs.append((53, "\n".join(" ".join(near[i:i + 100]) for i in range(0, 1200, 100))))  # the same, cut otherwise
    docs += [(54, prose(60) + " " + item + " " + prose(60)), (55, "too short"), (56, "Again " * 200), (57, None),
             (58, ""), (59, prose(60)), (59, prose(60))]
    return docs, [(1, item), (2, None)]


def written(tmp_path, spark):
    docs, items = corpus()
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs],
                          "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return docs


def test_stages(spark, tmp_path):
    written(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path)).checkpoint()
        assert docs.columns == columns
        kept[name] = {r.doc_id: r for r in docs.collect()}
    good = kept["quality_rules"]
    assert set(range(40)) | {50, 51, 52, 53, 54, 59} == set(good)
    after = kept["line_dedup"]
    assert set(good) - set(after) == {50}  # every line of the copy stands in document 0
    assert after[51].text.count("\n") == 1 and after[51].n_chars == len(after[51].text)
    assert all(after[i].text == good[i].text for i in range(40))
    assert set(after) - set(kept["simhash_near_dedup"]) == {53}
    assert set(kept["simhash_near_dedup"]) - set(kept["benchmark_decontamination"]) == {54}


def test_run_equals_the_stages_and_handles_no_rows(spark, tmp_path):
    written(tmp_path, spark)
    rows = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in rows} == set(range(40)) | {51, 52, 59} and all(r.n_tokens > 0 for r in rows)
    empty = tmp_path / "none"
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{tmp_path}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    assert P.run(spark, str(empty)).count() == 0


def test_line_lookup_without_broadcast(spark, tmp_path, monkeypatch):
    """The way beyond the broadcast bound gives the same rows."""
    monkeypatch.setattr(L, "BROADCAST_ROWS", 0)
    written(tmp_path, spark)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    got = P.line_dedup(spark, docs, str(tmp_path))
    monkeypatch.undo()
    want = P.line_dedup(spark, docs, str(tmp_path))
    key = lambda d: sorted(((r.doc_id, r.text) for r in d.collect()), key=str)
    assert key(got) == key(want)
