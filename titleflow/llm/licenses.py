"""Licence scan: Aho-Corasick over notice phrases and identifier tags, and a
shunting-yard evaluator for licence expressions.

Spark deals out the documents; inside a task each text is one pass: ASCII
letters are lower-cased and every other ASCII character becomes a blank, so
that a phrase is a run of whole words, and one automaton holding all
phrases finds every place of every phrase. Where the automaton meets the
identifier tag, the expression behind the tag (to the end of its line) is
tokenised, turned into postfix order by operator precedence (WITH before
AND before OR) and evaluated. Rows are independent: no shuffle, nothing
collected, memory is one Arrow batch.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

#: The phrases whose places count as base hits -> label.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Further notices -> label (words as they stand in licence texts).
NOTICES = {
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "apache license": "apache",
    "gnu general public license": "gpl",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "boost software license": "bsl",
    "isc license": "isc",
    "redistribution and use in source and binary forms": "bsd",
    "bsd 2 clause": "bsd-2",
    "bsd 3 clause": "bsd-3",
    "cc by": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "dedicated to the public domain": "public-domain",
    "all rights reserved": "all-rights-reserved",
}
TAG = "spdx license identifier"

#: Label -> how freely the text may be used (1: any use, 0: none). A longer
#: label falls back to its leading parts (``gpl-3.0-only`` -> ``gpl``).
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "bsl": 1.0, "zlib": 1.0, "unlicense": 1.0,
    "cc0": 1.0, "public-domain": 1.0, "0bsd": 1.0, "cc-by": 0.9, "mpl": 0.6, "lgpl": 0.6, "epl": 0.6,
    "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.1,
    "all-rights-reserved": 0.0,
}
UNKNOWN_FREEDOM = 0.5

#: ASCII letters in lower case, digits and all non-ASCII bytes as they are,
#: everything else a blank.
_FOLD = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32
              for b in range(256))
_TAGGED = re.compile(rb"(?i)spdx-license-identifier[ \t]*:[ \t]*([^\r\n]*)")
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+\-:]+")
_PRECEDENCE = {"OR": 1, "AND": 2, "WITH": 3}

SCHEMA = pa.schema([
    ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])


def known(label: str) -> float | None:
    """Freedom of a label, or of its longest leading part in the table."""
    parts = label.split("-")
    for n in range(len(parts), 0, -1):
        if (value := FREEDOM.get("-".join(parts[:n]))) is not None:
            return value
    return None


def freedom(label: str) -> float:
    value = known(label)
    return UNKNOWN_FREEDOM if value is None else value


def _identifier(token: str) -> str:
    """A token without the marks that end a sentence or a comment."""
    return token.rstrip(".-:")


def _ends(token: str) -> bool:
    """Whether a sentence or comment ends with the token."""
    return token not in "()" and _identifier(token) != token


def well_formed(tokens: list[str]) -> int:
    """Number of tokens of the longest prefix that is a whole expression."""
    longest, depth, operand_next = 0, 0, True
    for i, token in enumerate(tokens):
        if token == "(" and operand_next:
            depth += 1
        elif token == ")" and not operand_next and depth:
            depth -= 1
        elif token.upper() in _PRECEDENCE and not operand_next:
            operand_next = True
        elif operand_next and token not in "()" and token.upper() not in _PRECEDENCE and _identifier(token):
            operand_next = False
        else:
            break
        if not depth and not operand_next:
            longest = i + 1
            if _ends(token):
                break
    return longest


def to_postfix(expression: str | list[str]) -> list[str]:
    """Shunting-yard: an infix licence expression (or its tokens) in postfix
    order. Raises ValueError where operators, operands and parentheses don't fit."""
    tokens = _TOKEN.findall(expression) if isinstance(expression, str) else expression
    if not tokens or well_formed(tokens) != len(tokens):
        raise ValueError("not a whole expression")
    out, stack = [], []
    for token in tokens:
        op = token.upper()
        if token == "(":
            stack.append(token)
        elif token == ")":
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif op in _PRECEDENCE:
            while stack and _PRECEDENCE.get(stack[-1], 0) >= _PRECEDENCE[op]:
                out.append(stack.pop())
            stack.append(op)
        else:
            out.append(_identifier(token))
    return out + stack[::-1]


def evaluate(expression: str) -> tuple[float, frozenset[str]]:
    """Freedom and labels of the licence expression that a line begins with.

    OR offers a choice (the freer side counts), AND binds to both (the
    stricter side counts), WITH grants an exception to its left side and
    adds no label. What follows the longest well-formed expression (a
    comment's end, a further sentence) is no part of it, but for names of
    known licences before the sentence ends: they are joined by AND. Without
    any identifier it is ``(UNKNOWN_FREEDOM, {})``.
    """
    tokens = _TOKEN.findall(expression)
    whole = well_formed(tokens)
    stack: list[tuple[float, frozenset[str]]] = []
    for token in to_postfix(tokens[:whole]) if whole else []:
        if token not in _PRECEDENCE:
            stack.append((freedom(token.lower()), frozenset([token.lower()])))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        stack.append((a, left) if token == "WITH"
                     else (max(a, b) if token == "OR" else min(a, b), left | right))
    rest = []
    if not whole or not _ends(tokens[whole - 1]):
        for token in tokens[whole:]:
            if known(_identifier(token).lower()) is not None:
                rest.append((freedom(_identifier(token).lower()), frozenset([_identifier(token).lower()])))
            if _ends(token):
                break
    stack += rest
    return min((v for v, _ in stack), default=UNKNOWN_FREEDOM), frozenset().union(*(names for _, names in stack))


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase, label in NOTICES.items():
        found.add_word(f" {phrase} ", (phrase, label, False))
    for phrase, label in BASE_PHRASES.items():
        found.add_word(f" {phrase} ", (phrase, label, True))
    found.add_word(f" {TAG} ", (TAG, None, False))
    found.make_automaton()
    return found


def scan(raw: bytes, phrases: ahocorasick.Automaton) -> tuple:
    """One row of :data:`SCHEMA` for the UTF-8 bytes of a text."""
    words = raw.translate(_FOLD).split(b" ")
    words = [w for w in words if w] if b"" in words else words
    line = f" {b' '.join(words).decode()} "
    starts, base, labels, tagged, blanks = [], set(), set(), False, None
    for end, (phrase, label, is_base) in phrases.iter(line):
        if label is None:
            tagged = True
            continue
        labels.add(label)
        if is_base:
            base.add(label)
            blanks = blanks or [m.start() for m in re.finditer(" ", line)]  # the n-th word stands behind the n-th blank
            starts.append(bisect_left(blanks, end - len(phrase)) - 1)
    values = [freedom(x) for x in labels]
    if tagged:
        for m in _TAGGED.finditer(raw):
            value, names = evaluate(m[1].decode())
            if names:
                values.append(value)
                labels |= names
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), min(values, default=0.0))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: id and the columns of :data:`SCHEMA`.

    ``first_word`` / ``last_word`` are null without a base hit; ``labels``
    holds the base labels, those of the further notices and the identifiers
    of tagged expressions; ``score`` is the strictest freedom among all of
    them, 0 without any. Null and empty texts have no words and no labels;
    repeated rows and null ids give a row each; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        phrases = automaton()
        for batch in batches:
            rows = [scan(x or b"", phrases) for x in batch.column(1).cast(pa.binary()).to_pylist()]
            cols = [pa.array(c, f.type) for c, f in zip(zip(*rows), SCHEMA, strict=True)] if rows else [
                pa.array([], f.type) for f in SCHEMA]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], [id_col, *SCHEMA.names])

    kind = docs.schema[id_col].dataType.simpleString()
    out = (f"`{id_col}` {kind}, n_words long, n_base long, first_word long, last_word long, "
           "base_labels string, labels string, score double")
    return docs.select(id_col, text).mapInArrow(run, out)
