"""Registered end-to-end queries over the driver tables.

Roles of the driver tables:

* ``embeddings`` – model outputs: components 1-10 are the logits of model
  A, 11-20 those of model B, ``label`` (0..9) is the truth;
* ``documents`` – titles (``doc_id`` -> Id, ``text`` -> Title);
  ``labels`` gives the class ``quality * 2 + toxic``;
* ``benchmark`` – a second title source (the held-out file);
* ``part`` – short titles (``p_name``) with six classes (``p_type``);
* ``orders`` – a keyed table for the position index;
* ``events`` – the metric log: run = ``user_id``, metric =
  ``event_type``, step = ``event_id``, epoch = day of ``ts`` counted from
  the first day.

Every query reads whole tables and returns a DataFrame with the same
column names (and types) as its DuckDB oracle in
:mod:`titleflow.plans.oracle`. Ratios and losses are rounded to 6 digits
so that the two engines' last-bit differences do not matter.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from titleflow.functions.arrays import argmax, cross_entropy, fit_length
from titleflow.functions.text import sentences_treebank, tokenize_basic, tokenize_treebank, tokenize_words
from titleflow.operators import metrics as M
from titleflow.operators import sampling as S
from titleflow.operators import text as X
from titleflow.operators.joins import align_labels
from titleflow.operators.partitioning import spread
from titleflow.session import cut_lineage
from titleflow.sources.tables import read_table, without_labels

DIGITS = 6
EMB_CLASSES = 10
BATCH = 30
SEED = 42
MAX_LEN = 64
SENTENCE_LEN = 15


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return read_table(spark, sf, name)


# ---------------------------------------------------------------- logits

def _outputs(spark, sf) -> DataFrame:
    """One scan of ``embeddings``: both models' outputs and the truth sit
    in the same row, so predictions are compared with the truth in place -
    no self-join (which would shuffle the table twice for nothing). The
    join forms (``with_truth``, ``ensemble``) are for outputs and labels
    that live in different tables."""
    e = _t(spark, sf, "embeddings")
    return e.select(F.col("vec_id").alias("Id"),
                    F.slice("embedding", 1, 10).cast("array<double>").alias("z"),
                    F.slice("embedding", 11, 10).cast("array<double>").alias("z_b"),
                    F.col("label").alias("Genre"))


def _scored(spark, sf) -> DataFrame:
    return _outputs(spark, sf).select("Id", argmax("z").alias("pred"), "Genre")


def accuracy_overall(spark, sf):
    return M.accuracy(_scored(spark, sf), digits=DIGITS)


def accuracy_per_class(spark, sf):
    return M.per_class_accuracy(_scored(spark, sf), EMB_CLASSES, digits=DIGITS)


def accuracy_batch_mean(spark, sf):
    return M.batch_mean_accuracy(_scored(spark, sf), BATCH, order_by="Id", digits=DIGITS)


def loss_batch_mean(spark, sf):
    losses = _outputs(spark, sf).select("Id", cross_entropy("z", "Genre").alias("loss"))
    return M.batch_mean_loss(losses, BATCH, order_by="Id", digits=DIGITS)


def _ensemble(spark, sf) -> DataFrame:
    from titleflow.operators.models import ensemble_columns
    return ensemble_columns(_outputs(spark, sf), "z", "z_b", mode="raw")


def ensemble_predict(spark, sf):
    return _ensemble(spark, sf).select("Id", "pred_a", "pred_b", "pred")


def ensemble_per_class(spark, sf):
    return M.per_class_accuracy(_ensemble(spark, sf), EMB_CLASSES, digits=DIGITS)


def argmax_predictions(spark, sf):
    """Submission rows: Id = row position in key order, Genre = argmax."""
    pred = _outputs(spark, sf).select("Id", argmax("z").alias("Genre"))
    pos = S.with_position(pred, "Id", out="pos")
    return pos.select(F.col("pos").alias("Id"), "Genre")


# ---------------------------------------------------------------- titles

def _titles(spark, sf) -> DataFrame:
    return _t(spark, sf, "documents").select(F.col("doc_id").alias("Id"),
                                             F.col("text").alias("Title"))


def _labels(spark, sf) -> DataFrame:
    return _t(spark, sf, "labels").select(
        F.col("doc_id").alias("Id"),
        (F.col("quality") * 2 + F.col("toxic")).cast("int").alias("Genre"))


def _heldout(spark, sf) -> DataFrame:
    return _t(spark, sf, "benchmark").select(F.col("item_id").alias("Id"),
                                             F.col("text").alias("Title"))


def labelled_titles(spark, sf):
    return align_labels(_titles(spark, sf), _labels(spark, sf), on="Id", how="inner",
                        check="unique").select("Id", "Title", "Genre")


def unlabelled_titles(spark, sf):
    rest = _titles(spark, sf).join(_labels(spark, sf).select("Id"), "Id", "left_anti")
    return without_labels(rest).select("Id", "Title", "Genre")


def titles_optional_label(spark, sf):
    return align_labels(_titles(spark, sf), _labels(spark, sf), on="Id", how="left",
                        check=False).select("Id", "Title", "Genre")


def pooled_sources(spark, sf):
    pooled = S.pool(train=_titles(spark, sf), heldout=_heldout(spark, sf))
    return pooled.groupBy("source").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.sum(F.length("Title")).cast("long").alias("n_chars"))


def split_exact(spark, sf):
    return S.split_exact(_titles(spark, sf).select("Id"), "Id", 0.9, SEED).select("Id", "split")


def split_by_source(spark, sf):
    pooled = S.pool(train=_titles(spark, sf), validation=_heldout(spark, sf))
    tr, va = S.split_by_source(pooled, "train", "validation")
    out = tr.withColumn("split", F.lit("train")).unionByName(va.withColumn("split", F.lit("validation")))
    return out.select("split", "Id", F.length("Title").alias("n_chars"))


def epoch_batches(spark, sf):
    parts = _t(spark, sf, "part").select(F.col("p_partkey").alias("Id"))
    eb = S.epoch_batches(parts, "Id", epochs=3, size=64, seed=SEED)
    return eb.select(F.col("epoch").cast("int").alias("epoch"), "Id", "pos", "batch_id")


def step_count(spark, sf):
    return S.step_count(_t(spark, sf, "orders"), 50, 5)


def position_index(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("Id"), "o_totalprice")
    return S.with_position(o, "Id").select("Id", "pos", "o_totalprice")


def positional_pairs(spark, sf):
    """Row i of the title file next to row i of the output file, as far as both go."""
    from titleflow.operators.positional import pair_by_position
    pairs = pair_by_position(_t(spark, sf, "documents").select("doc_id", "lang"), _t(spark, sf, "embeddings").select("vec_id", "label"),
                             lengths="shortest")
    return pairs.select("pos", F.col("doc_id").alias("Id"), "lang", "vec_id", F.col("label").alias("Genre"))


EPOCHS, EPOCH_BATCH = 3, 64


def permuted_epochs(spark, sf):
    """Three epochs of the parts, each in an order computed from the row numbers."""
    from titleflow.operators.permutation import permuted_epochs as orders
    from titleflow.operators.positional import with_file_position
    parts = with_file_position(_t(spark, sf, "part")).select(F.col("p_partkey").alias("Id"), "pos")
    each = orders(parts, parts.count(), EPOCHS, EPOCH_BATCH, SEED)
    return each.select("epoch", "Id", "pos", "epoch_pos", "batch_id")


TAKE = [0, 1, 2, 3, 100, 1000, 4999, 9999, 14999]


def take_positions(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("Id"), "o_custkey")
    return S.take_positions(o, TAKE, "Id").select("pos", "Id", "o_custkey")


# ---------------------------------------------------------------- text

def _spread_titles(spark, sf) -> DataFrame:
    return spread(_titles(spark, sf), "Id")


def _basic_tokens(spark, sf) -> DataFrame:
    return _spread_titles(spark, sf).select("Id", tokenize_basic("Title").alias("tokens"))


def tokenize_basic_q(spark, sf):
    t = _basic_tokens(spark, sf)
    return t.select("Id", F.array_join("tokens", " ").alias("tokens"),
                    F.size("tokens").alias("n_tokens"))


def title_length_profile(spark, sf):
    p = X.length_profile(_basic_tokens(spark, sf), "tokens")
    return p.select(F.col("n_titles").cast("long").alias("n_titles"),
                    F.round("mean_tokens", DIGITS).alias("mean_tokens"),
                    F.col("max_tokens").cast("int").alias("max_tokens"),
                    F.col("min_tokens").cast("int").alias("min_tokens"),
                    F.col("median_tokens").cast("double").alias("median_tokens"))


def fit_length_q(spark, sf):
    t = _basic_tokens(spark, sf)
    return t.select("Id", F.concat_ws("|", fit_length("tokens", SENTENCE_LEN, "")).alias("fitted"),
                    F.least(F.size("tokens"), F.lit(SENTENCE_LEN)).alias("n_real"))


def remove_tokens(spark, sf):
    t = X.remove_tokens(_basic_tokens(spark, sf), "tokens", X.token_blocklist(), out="kept")
    return t.select("Id", F.array_join("kept", " ").alias("kept"), F.size("kept").alias("n_kept"))


def remove_tokens_join(spark, sf):
    """Same result as ``remove_tokens`` through the table strategy: explode,
    anti-join the block table, regroup."""
    t = X.remove_tokens(_basic_tokens(spark, sf), "tokens", X.token_blocklist(), out="kept",
                        strategy="join")
    return t.select("Id", F.array_join("kept", " ").alias("kept"), F.size("kept").alias("n_kept"))


def split_hash(spark, sf):
    return S.split_hash(_titles(spark, sf).select("Id"), "Id", 0.9, SEED).select("Id", "split")


def lemma_table(spark, sf):
    return _word_lemmas(spark, sf).select("token", "lemma")


def _word_lemmas(spark, sf) -> DataFrame:
    """Lemma table derived from the corpus itself: the dictionary is every
    lower-cased word token of ``documents``; surface forms are the kept
    tokens."""
    words = X.explode_values(_spread_titles(spark, sf).select(tokenize_words("Title").alias("t")), "t", "w")
    # the distinct surface forms are the only product of the pass over the
    # corpus; written once to the checkpoint folder (vocabulary-sized), the
    # dictionary, the candidate lemmas and the join's size check all read
    # that small table instead of tokenising the corpus again
    surface = cut_lineage(words.distinct())
    # lower-casing the distinct surface forms gives the same dictionary as
    # lower-casing every word
    dictionary = surface.select(F.lower("w").alias("lemma"))
    return X.suffix_lemmas(surface, dictionary)


def lemma_table_irregular(spark, sf):
    """The lemma table with irregular forms looked up before any rule."""
    from titleflow.operators.wordlists import IRREGULAR_NOUNS
    words = X.explode_values(_spread_titles(spark, sf).select(tokenize_words("Title").alias("t")), "t", "w")
    surface = cut_lineage(words.select(F.lower("w").alias("w")).distinct())
    return X.suffix_lemmas(surface, surface, exceptions=spark.createDataFrame(IRREGULAR_NOUNS, "token string, lemma string"))


def _pieces(spark, sf) -> DataFrame:
    """Sub-word vocabulary (token, id) of the held-out titles: their words,
    and those of up to four characters as pieces inside a word as well."""
    words = _heldout(spark, sf).select(F.explode(tokenize_basic("Title")).alias("token")).distinct()
    inner = words.where(F.char_length("token") <= 4).select(F.concat(F.lit("##"), F.col("token")).alias("token"))
    # the position index numbers them; the order is that of a hash, so that any engine can repeat it
    return S.with_position(words.unionByName(inner).distinct(), "token", seed=SEED).select(
        "token", (F.col("pos") + 4).cast("int").alias("id"))


def encode_pieces(spark, sf):
    """Titles as sub-word ids by greedy longest match."""
    from titleflow.operators.subword import encode_pieces as encode
    enc = encode(_basic_tokens(spark, sf), "tokens", _pieces(spark, sf), key="Id", max_len=MAX_LEN)
    return enc.select("Id", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
                      F.array_join(F.col("attention_mask").cast("array<string>"), " ").alias("attention_mask"), "n_tokens")


def clean_text(spark, sf):
    lemmas = _word_lemmas(spark, sf)
    c = X.clean(_spread_titles(spark, sf), "Title", lemmas=lemmas, key="Id")
    return c.select("Id", "clean_text", F.size("clean_tokens").alias("n_clean"))


def _vocab(spark, sf, n_specials=4) -> DataFrame:
    return X.build_vocab(_basic_tokens(spark, sf), "tokens", n_specials=n_specials)


def build_vocab(spark, sf):
    return _vocab(spark, sf).select("token", "id", "count")


def encode_titles(spark, sf):
    enc = X.encode(_basic_tokens(spark, sf), "tokens", _vocab(spark, sf), key="Id", max_len=MAX_LEN)
    return enc.select("Id", F.array_join(F.col("input_ids").cast("array<string>"), " ").alias("input_ids"),
                      F.array_join(F.col("attention_mask").cast("array<string>"), " ").alias("attention_mask"),
                      "n_tokens")


def embed_tokens(spark, sf):
    e = _t(spark, sf, "embeddings")
    vocab = _vocab(spark, sf, n_specials=0).select(
        "token", F.col("id").cast("long").alias("rank"))
    vectors = X.token_vectors_from_vocab(vocab, e)
    emb = X.embed_tokens(_basic_tokens(spark, sf), "tokens", vectors, 64, key="Id",
                         length=SENTENCE_LEN)
    total = F.aggregate(F.flatten("embedded"), F.lit(0.0).cast("double"), lambda a, x: a + x)
    return emb.select("Id", "n_known", F.round(total, DIGITS).alias("vec_sum"))


# ---------------------------------------------------------------- metric log

def _metric_log(spark, sf) -> DataFrame:
    ev = _t(spark, sf, "events")
    first_day = ev.select(F.to_date(F.min("ts"))).scalar()
    epoch = F.datediff(F.to_date("ts"), first_day) + 1
    return M.metric_log(ev, run_id="user_id", epoch=epoch, step="event_id",
                        metric="event_type", value="value")


def treebank_tokens(spark, sf):
    """Treebank tokens of every document, and its number of sentences."""
    d = spread(_t(spark, sf, "documents").select(F.col("doc_id").alias("Id"), "text"), "Id")
    d = d.select("Id", sentences_treebank("text").alias("s"))
    return d.select("Id", F.array_join(F.flatten("s"), " ").alias("tokens"),
                    F.aggregate("s", F.lit(0), lambda n, x: n + F.size(x)).alias("n_tokens"), F.size("s").alias("n_sentences"))


def clean_text_treebank(spark, sf):
    """Cleaned documents by treebank tokens: stop words and marks dropped."""
    d = spread(_t(spark, sf, "documents").select(F.col("doc_id").alias("Id"), F.col("text").alias("Title")), "Id")
    return X.clean(d, words_of=tokenize_treebank).select("Id", "clean_text", F.size("clean_tokens").alias("n_clean"))


HISTORY = {"training_loss": "click", "valid_loss": "view", "valid_accur": "purchase"}


def epoch_history(spark, sf):
    return M.epoch_history(_metric_log(spark, sf), HISTORY, digits=DIGITS)


def progress_log(spark, sf):
    return M.sample_log(_metric_log(spark, sf), 500).select("run_id", "epoch", "step", "metric",
                                                           F.round("value", DIGITS).alias("value"))


def best_run(spark, sf):
    from titleflow.operators.tuning import best_run as pick
    log = _metric_log(spark, sf)
    runs = (log.where(F.col("metric") == "purchase").groupBy("run_id")
            .agg(F.avg("value").alias("val_accuracy")))
    best = pick(runs, "val_accuracy")
    return best.select("run_id", F.round("val_accuracy", DIGITS).alias("val_accuracy"))


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from titleflow.plans import io_queries as IO
    from titleflow.plans import model_queries as MQ
    q = {
        "accuracy_overall": accuracy_overall,
        "accuracy_per_class": accuracy_per_class,
        "accuracy_batch_mean": accuracy_batch_mean,
        "loss_batch_mean": loss_batch_mean,
        "ensemble_predict": ensemble_predict,
        "ensemble_per_class": ensemble_per_class,
        "argmax_predictions": argmax_predictions,
        "labelled_titles": labelled_titles,
        "unlabelled_titles": unlabelled_titles,
        "titles_optional_label": titles_optional_label,
        "pooled_sources": pooled_sources,
        "split_exact": split_exact,
        "split_by_source": split_by_source,
        "epoch_batches": epoch_batches,
        "positional_pairs": positional_pairs,
        "permuted_epochs": permuted_epochs,
        "lemma_table_irregular": lemma_table_irregular,
        "encode_pieces": encode_pieces,
        "step_count": step_count,
        "position_index": position_index,
        "take_positions": take_positions,
        "tokenize_basic": tokenize_basic_q,
        "title_length_profile": title_length_profile,
        "fit_length": fit_length_q,
        "remove_tokens": remove_tokens,
        "remove_tokens_join": remove_tokens_join,
        "split_hash": split_hash,
        "lemma_table": lemma_table,
        "clean_text": clean_text,
        "treebank_tokens": treebank_tokens,
        "clean_text_treebank": clean_text_treebank,
        "build_vocab": build_vocab,
        "encode_titles": encode_titles,
        "embed_tokens": embed_tokens,
        "epoch_history": epoch_history,
        "progress_log": progress_log,
        "best_run": best_run,
    }
    q.update(MQ.registry())
    q.update(IO.registry())
    return q
