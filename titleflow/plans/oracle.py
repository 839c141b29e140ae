"""DuckDB SQL equivalents of the registered queries (the correctness gate).

The oracle is written independently of the Spark code where that is
possible: the title tokeniser applies the twelve basic_english rules one
by one (Spark applies them fused into five passes), positions come from
``row_number() OVER (ORDER BY ...)`` over the whole table (Spark uses the
bucketed position index), and medians use DuckDB's own ``median``.
DuckDB 2.0 lambdas are written ``lambda x: ...``; list indexes are
1-based.
"""

from __future__ import annotations

from titleflow.functions.text import BASIC_ENGLISH_RULES, WHITESPACE_CLASS, WORD_PATTERN, treebank_rules
from titleflow.operators.permutation import ROUNDS, epoch_key, round_hash
from titleflow.operators.text import token_blocklist
from titleflow.operators.wordlists import IRREGULAR_NOUNS, NOUN_SUFFIX_RULES
from titleflow.plans import queries as Q


def _lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _basic_tokens_sql(col: str) -> str:
    t = f"lower({col})"
    for pattern, repl in BASIC_ENGLISH_RULES:
        t = f"regexp_replace({t}, {_lit(pattern)}, {_lit(repl)}, 'g')"
    return (f"list_filter(string_split_regex({t}, {_lit(WHITESPACE_CLASS + '+')}), "
            f"lambda x: x <> '')")


T1 = _basic_tokens_sql("text")
BLOCK = ", ".join(_lit(w) for w in token_blocklist())
D = Q.DIGITS


def _logits(first: int, last: int) -> str:
    return f"CAST(embedding[{first}:{last}] AS DOUBLE[])"


SCORED = f"""
  scored AS (
    SELECT p.Id, p.pred, t.Genre
    FROM (SELECT vec_id AS Id,
                 CAST(list_position({_logits(1, 10)}, list_max({_logits(1, 10)})) - 1 AS INTEGER) AS pred
          FROM embeddings) p
    JOIN (SELECT vec_id AS Id, label AS Genre FROM embeddings) t USING (Id)
  )"""

ENSEMBLE = f"""
  ab AS (SELECT vec_id AS Id, {_logits(1, 10)} AS za, {_logits(11, 20)} AS zb FROM embeddings),
  prod AS (SELECT Id, za, zb, list_transform(range(1, 11), lambda i: za[i] * zb[i]) AS z FROM ab),
  ens AS (SELECT Id,
                 CAST(list_position(za, list_max(za)) - 1 AS INTEGER) AS pred_a,
                 CAST(list_position(zb, list_max(zb)) - 1 AS INTEGER) AS pred_b,
                 CAST(list_position(z, list_max(z)) - 1 AS INTEGER) AS pred
          FROM prod)"""


def _per_class(src: str) -> str:
    return f"""
SELECT CAST(c.range AS INTEGER) AS class,
       CAST(coalesce(s.n, 0) AS BIGINT) AS n,
       CAST(coalesce(s.n_correct, 0) AS BIGINT) AS n_correct,
       CASE WHEN coalesce(s.n, 0) = 0 THEN NULL
            ELSE round(100.0 * (coalesce(s.n_correct, 0) / CAST(s.n AS DOUBLE)), {D}) END AS accuracy
FROM range({Q.EMB_CLASSES}) c
LEFT JOIN (SELECT Genre, count(*) AS n, sum(CASE WHEN pred = Genre THEN 1 ELSE 0 END) AS n_correct
           FROM {src} GROUP BY Genre) s ON s.Genre = c.range"""


DOCS_TOKENS = f"d AS (SELECT doc_id AS Id, {T1} AS toks FROM documents)"

VOCAB_COUNTS = "cnt AS (SELECT token, count(*) AS c FROM (SELECT unnest(toks) AS token FROM d) GROUP BY token)"

LOG = """
  log AS (SELECT CAST(user_id AS VARCHAR) AS run_id,
                 CAST(date_diff('day', CAST((SELECT min(ts) FROM events) AS DATE), CAST(ts AS DATE)) + 1 AS INTEGER) AS epoch,
                 CAST(event_id AS BIGINT) AS step, event_type AS metric, CAST(value AS DOUBLE) AS value
          FROM events)"""


def _lemma_cands() -> str:
    parts = []
    for suffix, repl in NOUN_SUFFIX_RULES:
        n = len(suffix)
        parts.append(f"SELECT token, substr(token, 1, length(token) - {n}) || {_lit(repl)} AS lemma "
                     f"FROM surf WHERE suffix(token, {_lit(suffix)}) AND length(token) > {n}")
    return "\n      UNION ALL ".join(parts)


ORACLE = {
    "accuracy_overall": f"""
WITH {SCORED}
SELECT CAST(count(*) AS BIGINT) AS n,
       CAST(sum(CASE WHEN pred = Genre THEN 1 ELSE 0 END) AS BIGINT) AS n_correct,
       round(100.0 * (sum(CASE WHEN pred = Genre THEN 1 ELSE 0 END) / CAST(count(*) AS DOUBLE)), {D}) AS accuracy
FROM scored""",

    "accuracy_per_class": f"WITH {SCORED}\n" + _per_class("scored"),

    "accuracy_batch_mean": f"""
WITH {SCORED},
  b AS (SELECT floor((row_number() OVER (ORDER BY Id) - 1) / {Q.BATCH}) AS batch_id,
               CASE WHEN pred = Genre THEN 1.0 ELSE 0.0 END AS c FROM scored),
  per AS (SELECT batch_id, avg(c) AS acc FROM b GROUP BY batch_id)
SELECT CAST(count(*) AS BIGINT) AS n_batches, round(avg(acc), {D}) AS batch_mean_accuracy FROM per""",

    "loss_batch_mean": f"""
WITH z AS (SELECT vec_id AS Id, {_logits(1, 10)} AS z, label AS Genre FROM embeddings),
  m AS (SELECT Id, z, Genre, list_max(z) AS mx FROM z),
  l AS (SELECT Id, mx + ln(list_sum(list_transform(z, lambda x: exp(x - mx)))) - z[Genre + 1] AS loss FROM m),
  b AS (SELECT floor((row_number() OVER (ORDER BY Id) - 1) / {Q.BATCH}) AS batch_id, loss FROM l),
  per AS (SELECT batch_id, avg(loss) AS lb, sum(loss) AS s, count(*) AS c FROM b GROUP BY batch_id)
SELECT CAST(count(*) AS BIGINT) AS n_batches, round(sum(s) / sum(c), {D}) AS mean_loss,
       round(avg(lb), {D}) AS batch_mean_loss FROM per""",

    "ensemble_predict": f"WITH {ENSEMBLE}\nSELECT Id, pred_a, pred_b, pred FROM ens",

    "ensemble_per_class": f"""WITH {ENSEMBLE},
  scored AS (SELECT e.Id, e.pred, t.label AS Genre FROM ens e JOIN embeddings t ON t.vec_id = e.Id)
""" + _per_class("scored"),

    "argmax_predictions": f"""
SELECT CAST(row_number() OVER (ORDER BY vec_id) - 1 AS BIGINT) AS Id,
       CAST(list_position({_logits(1, 10)}, list_max({_logits(1, 10)})) - 1 AS INTEGER) AS Genre
FROM embeddings""",

    "labelled_titles": """
SELECT d.doc_id AS Id, d.text AS Title, CAST(l.quality * 2 + l.toxic AS INTEGER) AS Genre
FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",

    "unlabelled_titles": """
SELECT d.doc_id AS Id, d.text AS Title, CAST(NULL AS INTEGER) AS Genre
FROM documents d WHERE d.doc_id NOT IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)""",

    "titles_optional_label": """
SELECT d.doc_id AS Id, d.text AS Title, CAST(l.quality * 2 + l.toxic AS INTEGER) AS Genre
FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",

    "pooled_sources": """
SELECT source, CAST(count(*) AS BIGINT) AS n_rows, CAST(sum(length(Title)) AS BIGINT) AS n_chars
FROM (SELECT text AS Title, 'train' AS source FROM documents
      UNION ALL SELECT text AS Title, 'heldout' AS source FROM benchmark)
GROUP BY source""",

    "split_exact": f"""
WITH r AS (SELECT doc_id AS Id,
                  row_number() OVER (ORDER BY md5(CAST(doc_id AS VARCHAR) || '#{Q.SEED}')) - 1 AS pos,
                  count(*) OVER () AS n
           FROM documents)
SELECT Id, CASE WHEN pos < floor(CAST(0.9 AS DOUBLE) * n) THEN 'train' ELSE 'validation' END AS split
FROM r""",

    "split_by_source": """
SELECT 'train' AS split, doc_id AS Id, CAST(length(text) AS INTEGER) AS n_chars FROM documents
UNION ALL
SELECT 'validation' AS split, item_id AS Id, CAST(length(text) AS INTEGER) AS n_chars FROM benchmark""",

    "epoch_batches": f"""
WITH e AS (SELECT p_partkey AS Id, CAST(t.ep AS INTEGER) AS epoch FROM part, range(3) t(ep)),
  r AS (SELECT epoch, Id,
               CAST(row_number() OVER (PARTITION BY epoch
                    ORDER BY md5(CAST(Id AS VARCHAR) || '#{Q.SEED}' || '#' || CAST(epoch AS VARCHAR))) - 1 AS BIGINT) AS pos
        FROM e)
SELECT epoch, Id, pos, CAST(floor(pos / 64) AS BIGINT) AS batch_id FROM r""",

    "step_count": """
SELECT CAST(count(*) AS BIGINT) AS n_rows, 50 AS batch_size, 5 AS epochs,
       CAST(ceil(count(*) / 50.0) * 5 AS BIGINT) AS steps
FROM orders""",

    "position_index": """
SELECT o_orderkey AS Id, CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS pos, o_totalprice
FROM orders""",

    "take_positions": f"""
SELECT pos, Id, o_custkey FROM (
  SELECT CAST(row_number() OVER (ORDER BY o_orderkey) - 1 AS BIGINT) AS pos, o_orderkey AS Id, o_custkey
  FROM orders)
WHERE pos IN ({", ".join(str(p) for p in Q.TAKE)})""",

    "tokenize_basic": f"""
WITH {DOCS_TOKENS}
SELECT Id, array_to_string(toks, ' ') AS tokens, CAST(len(toks) AS INTEGER) AS n_tokens FROM d""",

    "title_length_profile": f"""
WITH {DOCS_TOKENS}, l AS (SELECT len(toks) AS n FROM d)
SELECT CAST(count(*) AS BIGINT) AS n_titles, round(avg(n), {D}) AS mean_tokens,
       CAST(max(n) AS INTEGER) AS max_tokens, CAST(min(n) AS INTEGER) AS min_tokens,
       CAST(median(n) AS DOUBLE) AS median_tokens
FROM l""",

    "fit_length": f"""
WITH {DOCS_TOKENS}
SELECT Id, array_to_string(list_resize(toks, {Q.SENTENCE_LEN}, ''), '|') AS fitted,
       CAST(least(len(toks), {Q.SENTENCE_LEN}) AS INTEGER) AS n_real
FROM d""",

    "remove_tokens": f"""
WITH {DOCS_TOKENS},
  k AS (SELECT Id, list_filter(toks, lambda t: lower(t) NOT IN ({BLOCK})) AS kept FROM d)
SELECT Id, array_to_string(kept, ' ') AS kept, CAST(len(kept) AS INTEGER) AS n_kept FROM k""",

    "split_hash": f"""
SELECT doc_id AS Id,
       CASE WHEN CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '#{Q.SEED}'), 1, 8)) AS BIGINT)
                 / CAST(4294967296 AS DOUBLE) < 0.9 THEN 'train' ELSE 'validation' END AS split
FROM documents""",

    "lemma_table": f"""
WITH d AS (SELECT doc_id AS Id, regexp_extract_all(text, {_lit(WORD_PATTERN)}) AS words FROM documents),
  t AS (SELECT unnest(words) AS tok FROM d),
  dict AS (SELECT DISTINCT lower(tok) AS lemma FROM t),
  surf AS (SELECT DISTINCT tok AS token FROM t),
  cand AS ({_lemma_cands()}),
  best0 AS (SELECT token, first(lemma ORDER BY length(lemma), lemma) AS lemma
            FROM cand WHERE lemma IN (SELECT lemma FROM dict) GROUP BY token)
SELECT token, lemma FROM best0
WHERE token NOT IN (SELECT lemma FROM dict) OR length(lemma) < length(token)""",

    "clean_text": f"""
WITH d AS (SELECT doc_id AS Id, regexp_extract_all(text, {_lit(WORD_PATTERN)}) AS words FROM documents),
  t AS (SELECT Id, unnest(words) AS tok, generate_subscripts(words, 1) AS pos FROM d),
  dict AS (SELECT DISTINCT lower(tok) AS lemma FROM t),
  surf AS (SELECT DISTINCT tok AS token FROM t),
  cand AS ({_lemma_cands()}),
  best0 AS (SELECT token, first(lemma ORDER BY length(lemma), lemma) AS lemma
            FROM cand WHERE lemma IN (SELECT lemma FROM dict) GROUP BY token),
  best AS (SELECT token, lemma FROM best0
           WHERE token NOT IN (SELECT lemma FROM dict) OR length(lemma) < length(token)),
  k AS (SELECT Id, tok, pos FROM t WHERE lower(tok) NOT IN ({BLOCK})),
  lem AS (SELECT k.Id, k.pos, coalesce(b.lemma, k.tok) AS w FROM k LEFT JOIN best b ON b.token = k.tok),
  agg AS (SELECT Id, list(w ORDER BY pos) AS ws FROM lem GROUP BY Id)
SELECT d.Id,
       CASE WHEN coalesce(len(agg.ws), 0) > 0 THEN array_to_string(agg.ws, ' ') || ' ' ELSE '' END AS clean_text,
       CAST(coalesce(len(agg.ws), 0) AS INTEGER) AS n_clean
FROM d LEFT JOIN agg USING (Id)""",

    "build_vocab": f"""
WITH {DOCS_TOKENS}, {VOCAB_COUNTS}
SELECT token, CAST(row_number() OVER (ORDER BY c DESC, token) - 1 + 4 AS INTEGER) AS id, CAST(c AS BIGINT) AS count
FROM cnt""",

    "encode_titles": f"""
WITH {DOCS_TOKENS}, {VOCAB_COUNTS},
  vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY c DESC, token) - 1 + 4 AS INTEGER) AS id FROM cnt),
  tr AS (SELECT Id, toks[1:{Q.MAX_LEN - 2}] AS tt FROM d),
  u AS (SELECT Id, unnest(tt) AS token, generate_subscripts(tt, 1) AS pos FROM tr),
  l AS (SELECT u.Id, u.pos, coalesce(v.id, 3) AS vid FROM u LEFT JOIN vocab v ON v.token = u.token),
  g AS (SELECT Id, list(vid ORDER BY pos) AS ids FROM l GROUP BY Id),
  f AS (SELECT tr.Id, list_concat(list_concat([1], coalesce(g.ids, CAST([] AS INTEGER[]))), [2]) AS body
        FROM tr LEFT JOIN g USING (Id))
SELECT Id, array_to_string(list_resize(body, {Q.MAX_LEN}, 0), ' ') AS input_ids,
       array_to_string(list_resize(list_resize([1], len(body), 1), {Q.MAX_LEN}, 0), ' ') AS attention_mask,
       CAST(len(body) AS INTEGER) AS n_tokens
FROM f""",

    "embed_tokens": f"""
WITH {DOCS_TOKENS}, {VOCAB_COUNTS},
  vocab AS (SELECT token, row_number() OVER (ORDER BY c DESC, token) - 1 AS rank FROM cnt),
  vec AS (SELECT v.token, e.embedding AS vector FROM vocab v JOIN embeddings e ON e.vec_id = v.rank),
  f AS (SELECT Id, list_resize(toks, {Q.SENTENCE_LEN}, '') AS ft FROM d),
  u AS (SELECT Id, unnest(ft) AS token, generate_subscripts(ft, 1) AS pos FROM f),
  j AS (SELECT u.Id, u.pos, vec.vector FROM u LEFT JOIN vec ON vec.token = u.token AND u.token <> '')
SELECT Id, CAST(count(vector) AS INTEGER) AS n_known,
       round(coalesce(sum(list_sum(CAST(vector AS DOUBLE[]))), 0.0), {D}) AS vec_sum
FROM j GROUP BY Id""",

    "epoch_history": f"""
WITH {LOG}
SELECT epoch,
       round(avg(value) FILTER (WHERE metric = 'click'), {D}) AS training_loss,
       round(avg(value) FILTER (WHERE metric = 'view'), {D}) AS valid_loss,
       round(avg(value) FILTER (WHERE metric = 'purchase'), {D}) AS valid_accur
FROM log WHERE metric IN ('click', 'view', 'purchase') GROUP BY epoch""",

    "progress_log": f"""
WITH {LOG}
SELECT run_id, epoch, step, metric, round(value, {D}) AS value FROM log WHERE (step + 1) % 500 = 0""",

    "best_run": f"""
WITH {LOG},
  runs AS (SELECT run_id, avg(value) AS val_accuracy FROM log WHERE metric = 'purchase' GROUP BY run_id)
SELECT run_id, round(val_accuracy, {D}) AS val_accuracy FROM runs
ORDER BY val_accuracy DESC, run_id ASC LIMIT 1""",
}


ORACLE["remove_tokens_join"] = ORACLE["remove_tokens"]

#: Multinomial naive Bayes with smoothing 1 from counts: log prior
#: ln(n_c + 1) - ln(n + k), log weight ln(count + 1) - ln(total_c + |V|).
NAIVE_BAYES = f"""
  cls AS (SELECT p_type, CAST(row_number() OVER (ORDER BY p_type) - 1 AS INTEGER) AS Genre
          FROM (SELECT DISTINCT p_type FROM part)),
  p AS (SELECT p_partkey AS Id, cls.Genre, {_basic_tokens_sql("p_name")} AS toks,
               row_number() OVER (ORDER BY md5(CAST(p_partkey AS VARCHAR) || '#{Q.SEED}')) - 1
                 < floor(CAST(0.9 AS DOUBLE) * count(*) OVER ()) AS train
        FROM part JOIN cls USING (p_type)),
  tr AS (SELECT Genre, unnest(toks) AS token FROM p WHERE train),
  classes AS (SELECT Genre, count(*) AS n_docs FROM p WHERE train GROUP BY Genre),
  vocab AS (SELECT DISTINCT token FROM tr),
  cnt AS (SELECT Genre, token, count(*) AS c FROM tr GROUP BY Genre, token),
  tot AS (SELECT Genre, count(*) AS total FROM tr GROUP BY Genre),
  prior AS (SELECT c.Genre, coalesce(tot.total, 0) AS total,
                   ln(n_docs + 1.0) - ln((SELECT sum(n_docs) FROM classes) + (SELECT count(*) FROM classes) * 1.0) AS pi
            FROM classes c LEFT JOIN tot USING (Genre)),
  u AS (SELECT Id, unnest(toks) AS token FROM p WHERE NOT train),
  w AS (SELECT u.Id, prior.Genre AS k,
               sum(ln(coalesce(cnt.c, 0) + 1.0) - ln(prior.total + (SELECT count(*) FROM vocab) * 1.0)) AS s
        FROM u JOIN vocab USING (token) CROSS JOIN prior
        LEFT JOIN cnt ON cnt.Genre = prior.Genre AND cnt.token = u.token GROUP BY u.Id, prior.Genre),
  z AS (SELECT p.Id, p.Genre, prior.Genre AS k, round(pi + coalesce(w.s, 0.0), 9) AS z
        FROM p CROSS JOIN prior LEFT JOIN w ON w.Id = p.Id AND w.k = prior.Genre WHERE NOT p.train),
  nb AS (SELECT Id, Genre, CAST(first(k ORDER BY z DESC, k) AS INTEGER) AS pred, max(z) AS best
         FROM z GROUP BY Id, Genre)"""

ORACLE["naive_bayes_titles"] = f"WITH {NAIVE_BAYES}\nSELECT Id, Genre, pred, round(best, 6) AS log_score FROM nb"

ORACLE["naive_bayes_per_class"] = f"""WITH {NAIVE_BAYES},
  s AS (SELECT Genre, count(*) AS n, sum(CASE WHEN pred = Genre THEN 1 ELSE 0 END) AS n_correct FROM nb GROUP BY Genre)
SELECT CAST(c.range AS INTEGER) AS class, CAST(coalesce(n, 0) AS BIGINT) AS n,
       CAST(coalesce(n_correct, 0) AS BIGINT) AS n_correct,
       CASE WHEN n > 0 THEN round(100.0 * (n_correct / CAST(n AS DOUBLE)), {D}) END AS accuracy
FROM range(6) c LEFT JOIN s ON s.Genre = c.range"""


ORACLE["positional_pairs"] = """
WITH x AS (SELECT row_number() OVER () - 1 AS pos, doc_id AS Id, lang FROM documents),
  y AS (SELECT row_number() OVER () - 1 AS pos, vec_id, label AS Genre FROM embeddings)
SELECT pos, Id, lang, vec_id, Genre FROM x JOIN y USING (pos)"""

ORACLE["lemma_table_irregular"] = f"""
WITH d AS (SELECT doc_id AS Id, regexp_extract_all(text, {_lit(WORD_PATTERN)}) AS words FROM documents),
  dict AS (SELECT DISTINCT lower(tok) AS lemma FROM (SELECT unnest(words) AS tok FROM d)),
  irregular(token, lemma) AS (VALUES {", ".join(f"({_lit(t)}, {_lit(m)})" for t, m in IRREGULAR_NOUNS)}),
  surf AS (SELECT lemma AS token FROM dict WHERE lemma NOT IN (SELECT token FROM irregular)),
  cand AS ({_lemma_cands()}),
  best AS (SELECT token, first(lemma ORDER BY length(lemma), lemma) AS lemma
           FROM cand WHERE lemma IN (SELECT lemma FROM dict) GROUP BY token)
SELECT token, lemma FROM best WHERE length(lemma) < length(token)
UNION ALL SELECT i.token, i.lemma FROM irregular i JOIN dict ON dict.lemma = i.token"""

ORACLE["encode_pieces"] = f"""
WITH RECURSIVE {DOCS_TOKENS},
  held AS (SELECT DISTINCT unnest({T1}) AS token FROM benchmark),
  names AS (SELECT token FROM held UNION SELECT '##' || token FROM held WHERE length(token) <= 4),
  vocab AS (SELECT token, CAST(row_number() OVER (ORDER BY md5(token || '#{Q.SEED}')) - 1 + 4 AS INTEGER) AS id FROM names),
  tr AS (SELECT Id, toks[1:{Q.MAX_LEN - 2}] AS tt FROM d),
  u AS (SELECT Id, unnest(tt) AS word, generate_subscripts(tt, 1) AS pos FROM tr),
  walk AS (
    SELECT word, 1 AS beg, CAST([] AS INTEGER[]) AS ids FROM (SELECT DISTINCT word FROM u WHERE length(word) <= 100)
    UNION ALL
    SELECT word, beg + n, list_append(ids, id) FROM (
      SELECT w.word, w.beg, w.ids, s.n, v.id, row_number() OVER (PARTITION BY w.word ORDER BY s.n DESC) AS o
      FROM walk w, (SELECT unnest(range(1, 101)) AS n) s, vocab v
      WHERE w.beg <= length(w.word) AND s.n <= length(w.word) - w.beg + 1
        AND v.token = CASE WHEN w.beg = 1 THEN '' ELSE '##' END || substr(w.word, w.beg, s.n)) WHERE o = 1),
  done AS (SELECT word, ids FROM walk WHERE beg = length(word) + 1),
  l AS (SELECT u.Id, u.pos, coalesce(done.ids, [3]) AS ids FROM u LEFT JOIN done USING (word)),
  g AS (SELECT Id, flatten(list(ids ORDER BY pos))[1:{Q.MAX_LEN - 2}] AS ids FROM l GROUP BY Id),
  f AS (SELECT tr.Id, list_concat(list_concat([1], coalesce(g.ids, CAST([] AS INTEGER[]))), [2]) AS body
        FROM tr LEFT JOIN g USING (Id))
SELECT Id, array_to_string(list_resize(body, {Q.MAX_LEN}, 0), ' ') AS input_ids,
       array_to_string(list_resize(list_resize([1], len(body), 1), {Q.MAX_LEN}, 0), ' ') AS attention_mask,
       CAST(len(body) AS INTEGER) AS n_tokens
FROM f"""


def _permuted(source: str) -> str:
    """(Id, pos, epoch, v) with v permuted once: rounds of the keyed permutation as nested selects."""
    key = epoch_key(Q.SEED, "CAST(epoch AS BIGINT)")
    rows = f"(SELECT Id, pos, epoch, n, a, b, v // b AS l, v % b AS r FROM {source}, dim)"
    for i in range(1, ROUNDS + 1):
        rows = f"(SELECT Id, pos, epoch, n, a, b, (l + {round_hash('r', key, str(2 * i))}) % a AS l, r FROM {rows})"
        rows = f"(SELECT Id, pos, epoch, n, a, b, l, (r + {round_hash('l', key, str(2 * i + 1))}) % b AS r FROM {rows})"
    return f"SELECT Id, pos, epoch, CAST(l * b + r AS BIGINT) AS v FROM {rows}"


ORACLE["permuted_epochs"] = f"""
WITH RECURSIVE p AS (SELECT p_partkey AS Id, CAST(row_number() OVER () - 1 AS BIGINT) AS pos FROM part),
  size AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS BIGINT) AS a FROM part),
  dim AS (SELECT n, a, (n + a - 1) // a AS b FROM size),
  each AS (SELECT Id, pos, epoch, pos AS v FROM p, (SELECT CAST(unnest(range({Q.EPOCHS})) AS INTEGER) AS epoch)),
  walk AS ({_permuted('each')}
           UNION ALL {_permuted('(SELECT walk.* FROM walk, size WHERE v >= n)')})
SELECT epoch, Id, pos, v AS epoch_pos, v // {Q.EPOCH_BATCH} AS batch_id FROM walk, size WHERE v < n"""


ORACLE["feature_file"] = """
SELECT doc_id AS Id, doc_id || '.png' AS Cover, md5(coalesce(text, '')) AS title_md5,
       CAST(length(coalesce(text, '')) AS INTEGER) AS n_chars FROM documents"""

ORACLE["feature_file_by_position"] = """
SELECT doc_id AS Id, 'c' || (doc_id % 97) AS image, md5(coalesce(text, '')) AS title_md5 FROM documents"""

ORACLE["labelled_files"] = """
SELECT doc_id AS Id, CAST(quality * 2 + toxic AS INTEGER) AS Genre, md5(coalesce(text, '')) AS title_md5
FROM documents JOIN labels USING (doc_id)"""

ORACLE["submission_file"] = ORACLE["argmax_predictions"]
ORACLE["metric_log_file"] = ORACLE["epoch_history"]
ORACLE["ensemble_join"] = ORACLE["ensemble_predict"]

ORACLE["token_vector_file"] = f"""
SELECT 'w' || vec_id AS token, CAST(len(embedding) AS INTEGER) AS dim,
       round(list_sum(CAST(embedding AS DOUBLE[])), {D}) AS vec_sum FROM embeddings"""

ORACLE["vocabulary_file"] = f"""
WITH t AS (SELECT unnest({_basic_tokens_sql("p_name")}) AS token FROM part),
  c AS (SELECT token, count(*) AS c FROM t GROUP BY token)
SELECT token, CAST(row_number() OVER (ORDER BY c DESC, token) - 1 AS INTEGER) AS id FROM c"""

ORACLE["stored_positions"] = """
WITH o AS (SELECT o_orderkey AS Id, o_custkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS pos FROM orders)
SELECT o.pos, Id, o_custkey FROM part JOIN o ON o.pos = p_partkey * 7"""

ORACLE["encode_titles_pad_end"] = ORACLE["encode_titles"].replace(
    f"list_resize(body, {Q.MAX_LEN}, 0)", f"list_resize(body, {Q.MAX_LEN}, 2)").split("array_to_string(list_resize(list_resize")[0] + (
    "CAST(len(body) AS INTEGER) AS n_mask\nFROM f")

#: Pixel (h, w, c) is byte (4 h + w) 4 + c; channels first puts it at 16 c + 4 h + w.
ORACLE["cover_images"] = """
WITH px AS (SELECT vec_id AS Id, list_transform(embedding, lambda x:
              least(255, greatest(0, floor(128 + 256 * CAST(x AS DOUBLE)))) / 255.0) AS p FROM embeddings),
  st AS (SELECT Id, p, list_avg(p) AS m, list_aggregate(p, 'stddev_samp') AS s, list_min(p) = list_max(p) AS flat FROM px),
  y AS (SELECT Id, flat, list_sum(list_transform(range(0, 64), lambda k:
          (k + 1) * CAST(CAST((p[(k % 16) * 4 + k // 16 + 1] - m) / s AS FLOAT) AS DOUBLE))) AS weighted FROM st)
SELECT d.doc_id AS Id, y.Id IS NOT NULL AS has_image, y.Id IS NOT NULL AS shape_ok, y.flat AS is_constant,
       round(y.weighted, 4) AS weighted
FROM documents d LEFT JOIN y ON y.Id = d.doc_id"""


def _treebank_sql(col: str) -> str:
    """Sentences as token lists: the ordered rules one by one, sentences cut at their mark."""
    t = f"(' ' || {col} || ' ')"
    for pattern, repl in treebank_rules():
        t = f"regexp_replace({t}, {_lit(pattern)}, {_lit(repl.replace('$', chr(92)))}, 'g')"
    words = f"list_filter(string_split_regex(replace(p, chr(1), '.'), {_lit(WHITESPACE_CLASS + '+')}), lambda w: w <> '')"
    return f"list_filter(list_transform(string_split({t}, chr(2)), lambda p: {words}), lambda s: len(s) > 0)"


TREEBANK = f"d AS (SELECT doc_id AS Id, {_treebank_sql('text')} AS s FROM documents), t AS (SELECT Id, s, flatten(s) AS toks FROM d)"

ORACLE["treebank_tokens"] = f"""
WITH {TREEBANK}
SELECT Id, array_to_string(toks, ' ') AS tokens, CAST(len(toks) AS INTEGER) AS n_tokens,
       CAST(len(s) AS INTEGER) AS n_sentences FROM t"""

ORACLE["clean_text_treebank"] = f"""
WITH {TREEBANK},
  k AS (SELECT Id, list_filter(toks, lambda w: lower(w) NOT IN ({BLOCK})) AS kept FROM t)
SELECT Id, CASE WHEN len(kept) > 0 THEN array_to_string(kept, ' ') || ' ' ELSE '' END AS clean_text,
       CAST(len(kept) AS INTEGER) AS n_clean FROM k"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
