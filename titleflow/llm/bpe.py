"""Byte-level BPE encoding and decoding with DuckDB recursive queries.

Spark deals out the documents; each Arrow batch is cut into pieces by the
tokenizer's pattern, and the distinct pieces that the task has not met yet
go to an in-process DuckDB as token-position rows. A recursive query joins
the neighbouring tokens with the merge table and contracts, step by step,
each piece's leftmost pair of minimum rank until no pair is left. The ids
come back by an ordered aggregation, and so do the bytes of the decoded ids.

A document's ids are those of its pieces one after the other. Memory is one
batch, one block of pieces and a bounded cache of encoded pieces (the
older generation goes when it is full, which costs time only). A piece of n bytes takes up to n steps of
n rows: its time grows with the square of its length, its memory does not.
Rank files are read once on the driver (a vocabulary has a fixed size) and
broadcast, so executors need no file.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Token-position rows of the pieces that are encoded together.
BLOCK_ROWS = 200_000
#: Rows that a recursive query may pile up over its steps.
STEP_ROWS = 5_000_000
#: Encoded pieces in one of the two generations that a Python worker remembers.
CACHE_PIECES = 400_000

_TABLES = """
CREATE TABLE vocab AS SELECT bytes, hex(bytes) AS digits, id::INT AS id FROM ranks;
CREATE TABLE merges AS
SELECT (a.id::BIGINT << 32) | b.id AS pair, v.id AS m
FROM (SELECT id, bytes, unnest(range(1, octet_length(bytes))) AS cut FROM vocab) v
JOIN vocab a ON a.bytes = from_hex(left(hex(v.bytes), 2 * v.cut::INT))
JOIN vocab b ON b.bytes = from_hex(substr(hex(v.bytes), 2 * v.cut::INT + 1));
"""

#: Token-position rows: a token's place, the place of the next one and the
#: next token. A piece that is a token itself starts as it.
_START = """
SELECT w, p, tok, np, nt FROM bytes ANTI JOIN (SELECT w FROM pieces JOIN vocab USING (bytes)) whole USING (w)
UNION ALL SELECT w, 0, id, NULL, NULL FROM pieces JOIN vocab USING (bytes)
"""

#: One step of a piece contracts its leftmost pair of minimum rank. Rank and
#: both places of a pair are one number, whose minimum is that pair: the left
#: row goes, the right row takes the merged token, and the row before them
#: gets a new neighbour. Rows of a piece without a pair are passed on once
#: more as not live.
_CONTRACT = """
WITH RECURSIVE t(w, p, tok, np, nt, step, live) AS (
    SELECT w, p, tok, np, nt, 0, true FROM state
  UNION ALL
    (WITH pair AS MATERIALIZED (
        SELECT t.*, (m.m::$number << $two) | (t.p::$number << $one) | t.np AS k
        FROM t LEFT JOIN merges m ON m.pair = (t.tok::BIGINT << 32) | t.nt WHERE t.live AND t.step < $steps),
     best AS (SELECT w, min(k) AS k, (min(k) >> $two)::INT AS m, ((min(k) >> $one) & $mask)::INT AS p,
                     (min(k) & $mask)::INT AS np FROM pair GROUP BY w)
     SELECT x.w, x.p, CASE WHEN x.p = b.np THEN b.m ELSE x.tok END, CASE WHEN x.np = b.p THEN b.np ELSE x.np END,
            CASE WHEN x.np = b.p THEN b.m ELSE x.nt END, x.step + 1, b.k IS NOT NULL
     FROM pair x JOIN best b ON b.w = x.w WHERE b.k IS NULL OR x.p <> b.p)
) SELECT * FROM t WHERE NOT live OR step = $steps
"""

_DECODE = """
SELECT w, string_agg(tok, ',' ORDER BY p) AS ids, string_agg(v.digits, '' ORDER BY p) AS decoded
FROM done JOIN vocab v ON v.id = tok GROUP BY w
"""


class Encoder:
    """One DuckDB connection with the vocabulary, and the remembered pieces."""

    def __init__(self, ranks: bytes, pattern: str):
        lines = [x.split() for x in ranks.splitlines() if x]
        table = pa.table({"bytes": pa.array([base64.b64decode(a) for a, _ in lines], pa.binary()),  # noqa: F841
                          "id": pa.array([int(b) for _, b in lines], pa.int64())})
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self.db.register("ranks", table)
        self.db.execute(_TABLES)
        self.db.unregister("ranks")
        single = {a[0]: i for a, i in zip(table["bytes"].to_pylist(), table["id"].to_pylist(), strict=True) if len(a) == 1}
        if len(single) < 256:
            raise ValueError("the vocabulary lacks a token for some byte")
        self.single = np.array([single[b] for b in range(256)], np.int32)
        self.find = regex.compile(pattern).findall
        self.known: dict[str, tuple[str, bytes]] = {}
        self.older: dict[str, tuple[str, bytes]] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode and decode pieces in blocks of bounded size."""
        block, rows = [], 0
        for piece in pieces:
            raw = piece.encode()
            block.append((piece, raw))
            rows += len(raw)
            if rows >= BLOCK_ROWS:
                self._learn(block)
                block, rows = [], 0
        if block:
            self._learn(block)

    def _learn(self, block: list[tuple[str, bytes]]) -> None:
        raw = [b for _, b in block]
        self.db.register("pieces", pa.table({"w": pa.array(np.arange(len(raw), dtype=np.int32)),
                                             "bytes": pa.array(raw, pa.binary())}))
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        ends = np.cumsum(sizes)
        tok = self.single[np.frombuffer(b"".join(raw), np.uint8)]
        p = np.arange(len(tok)) - np.repeat(ends - sizes, sizes)
        last = np.zeros(len(tok), bool)
        last[ends - 1] = True
        self.db.register("bytes", pa.table({
            "w": pa.array(np.repeat(np.arange(len(raw), dtype=np.int32), sizes)), "p": pa.array(p.astype(np.int32)),
            "tok": pa.array(tok), "np": pa.array((p + 1).astype(np.int32), mask=last),
            "nt": pa.array(np.roll(tok, -1), mask=last)}))
        run = lambda sql: self.db.execute(sql).fetchall()
        # places of 22 bits fit into 64 with the rank; longer pieces take 128
        short = max(len(b) for _, b in block) < 1 << 22
        bits = 22 if short else 40
        shape = {"$number": "BIGINT" if short else "HUGEINT", "$two": str(2 * bits), "$one": str(bits),
                 "$mask": str((1 << bits) - 1)}
        run(f"CREATE OR REPLACE TEMP TABLE state AS {_START}")
        run("CREATE OR REPLACE TEMP TABLE done (w INT, p INT, tok INT)")
        while rows := run("SELECT count(*) FROM state")[0][0]:
            # a query keeps the rows of all its steps: fewer steps for more rows
            query = _CONTRACT.replace("$steps", str(max(4, STEP_ROWS // rows)))
            for name, value in shape.items():
                query = query.replace(name, value)
            run(f"CREATE OR REPLACE TEMP TABLE reached AS {query}")
            run("INSERT INTO done SELECT w, p, tok FROM reached WHERE NOT live")
            run("CREATE OR REPLACE TEMP TABLE state AS SELECT w, p, tok, np, nt FROM reached WHERE live")
        got = self.db.sql(_DECODE).to_arrow_table()
        self.db.unregister("pieces")
        self.db.unregister("bytes")
        places, ids, decoded = (c.to_pylist() for c in got.columns)
        for w, i, d in zip(places, ids, decoded, strict=True):
            self.known[block[w][0]] = (i, bytes.fromhex(d))

    def encode(self, texts: list[str]) -> Iterator[tuple[str, int, bytes]]:
        """(ids joined by commas, their number, decoded bytes) of each text."""
        cut = list(map(self.find, texts))
        if len(self.known) > CACHE_PIECES:  # what is used again moves on to the new generation
            self.older, self.known = self.known, {}
        known, older = self.known, self.older
        new = set().union(*cut) - known.keys()
        known.update((p, older[p]) for p in new & older.keys())
        self.learn(new - older.keys())
        for pieces in cut:
            found = [known[p] for p in pieces]
            ids = ",".join([f[0] for f in found])
            yield ids, ids.count(",") + bool(ids), b"".join([f[1] for f in found])


@lru_cache(maxsize=2)
def _encoder(ranks: bytes, pattern: str) -> Encoder:
    return Encoder(ranks, pattern)


def _groups(texts: list[str], chars: int = 4 << 20) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of some ``chars`` characters together."""
    at = size = 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= chars:
            yield at, texts[at:i + 1]
            at, size = i + 1, 0
    if at < len(texts):
        yield at, texts[at:]


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, ranks_path: str, pattern: str, text: str = "text",
                     with_ids: bool = False) -> DataFrame:
    """All columns of ``docs`` but the text, and ``n_tokens``, ``ids_sha256``
    (of the decimal ids joined by commas), ``decoded_sha256`` (of the decoded
    ids' bytes); ``with_ids`` adds the ids as array and the decoded text.

    Null and empty texts have no tokens; repeated rows give a row each;
    columns of ``docs`` with a result's name give way to it.
    """
    spark: SparkSession = docs.sparkSession
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))
    results = ["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids", "decoded"] * with_ids
    keep = [c for c in docs.columns if c != text and c not in results]
    kinds = [pa.int64(), pa.string(), pa.string()] + [pa.list_(pa.int32()), pa.string()] * with_ids

    def row(ids: str, n: int, raw: bytes) -> tuple:
        out = (n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(raw).hexdigest())
        return out + (([int(x) for x in ids.split(",")] if ids else [], raw.decode()) if with_ids else ())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
            for at, group in _groups(texts):
                rows = [row(*x) for x in encoder.encode(group)]
                cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*(c.slice(at, len(group)) for c in batch.columns[:-1]), *cols], [*keep, *results])

    types = ["long", "string", "string"] + ["array<int>", "string"] * with_ids
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep]
                       + [f"{n} {t}" for n, t in zip(results, types, strict=True)])
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text)).mapInArrow(run, schema)
