import re

import pytest

from titleflow.llm import licenses as L


def brute_base(text):
    w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places, labels = [], set()
    for phrase, label in L.BASE_PHRASES.items():
        p = phrase.split()
        for i in range(len(w) - len(p) + 1):
            if w[i:i + len(p)] == p:
                places.append(i)
                labels.add(label)
    return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))


TEXTS = [
    None, "", " .,;", "Released under the MIT License.", "UNDER  THE\nMIT-LICENSE, under the mit license",
    "Apache License, Version 2.0.", "apache license version 20", "Apache Licence version 2", "CC BY-NC 4.0 cc_by_nc",
    "under the mit licenses", "thunder the mit license", "ünder the mit license", "é under the mit license é",
    "mit license " * 3000 + "under the mit license", "x" * 100_000 + " cc by nc",
    "under the mit license apache license version 2 cc by nc " * 50,
]


def test_base_hits_against_brute_force(spark):
    rows = [(i, t, "x", 0.5) for i, t in enumerate(TEXTS)] + [(900, "cc by nc", "", 1.0)] * 2 + [(None, "mit", "", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, labels string, score double")
    out = L.scan_licenses(docs).collect()
    assert len(out) == len(rows)
    for r in out:
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(text), text
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and r.labels == ",".join(sorted(set(r.labels.split(","))))
    assert L.scan_licenses(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("expression", "postfix"), [
    ("MIT", ["MIT"]),
    ("MIT OR Apache-2.0 AND ISC", ["MIT", "Apache-2.0", "ISC", "AND", "OR"]),
    ("(MIT OR Apache-2.0) AND ISC", ["MIT", "Apache-2.0", "OR", "ISC", "AND"]),
    ("GPL-2.0-only WITH Classpath-exception-2.0 or MIT", ["GPL-2.0-only", "Classpath-exception-2.0", "WITH", "MIT", "OR"]),
    ("a AND b AND c", ["a", "b", "AND", "c", "AND"]),
])
def test_shunting_yard(expression, postfix):
    assert L.to_postfix(expression) == postfix


@pytest.mark.parametrize("bad", ["", "MIT OR", "AND MIT", "(MIT", "MIT)", "MIT ISC", "()", "MIT (ISC)"])
def test_malformed_expressions(bad):
    with pytest.raises(ValueError):
        L.to_postfix(bad)
    value, names = L.evaluate(bad)
    assert 0 <= value <= 1 and names == frozenset(x.lower() for x in re.findall("MIT|ISC", bad))


def test_evaluation():
    assert L.evaluate("MIT OR GPL-3.0-only") == (1.0, {"mit", "gpl-3.0-only"})
    assert L.evaluate("MIT AND GPL-3.0-only")[0] == L.FREEDOM["gpl"]
    assert L.evaluate("(MIT OR GPL-3.0-only) AND CC-BY-NC-4.0")[0] == L.FREEDOM["cc-by-nc"]
    assert L.evaluate("GPL-2.0-only WITH Classpath-exception-2.0") == (L.FREEDOM["gpl"], {"gpl-2.0-only"})
    assert L.evaluate("LicenseRef-own")[0] == L.UNKNOWN_FREEDOM


def test_tagged_expression_in_a_text():
    found = L.scan(b"// SPDX-License-Identifier: (MIT OR Apache-2.0) AND ISC\r\ncode under the mit license", L.automaton())
    assert found[5] == "apache-2.0,isc,mit" and found[4] == "mit" and found[6] == 1.0
    nested = L.scan(b"SPDX-License-Identifier:" + b"(" * 5000 + b"MIT" + b")" * 5000, L.automaton())
    assert nested[5] == "mit"


@pytest.mark.parametrize(("line", "labels"), [
    ("<!-- SPDX-License-Identifier: MIT -->", "mit"), ("SPDX-License-Identifier: MIT. See the LICENSE file for details", "mit"),
    ("/* SPDX-License-Identifier: GPL-2.0+ OR MIT */", "gpl-2.0+,mit"), ("SPDX-License-Identifier: MIT AND (ISC", "isc,mit"),
    ("# SPDX-License-Identifier: Apache-2.0 WITH LLVM-exception -- note", "apache-2.0"),
    ("SPDX-License-Identifier: see below", "see"), ("SPDX-License-Identifier:", ""), ("SPDX-License-Identifier: -- --", ""),
])
def test_what_follows_an_expression_is_no_label(line, labels):
    assert L.scan(line.encode(), L.automaton())[5] == labels


def test_many_hits_take_linear_time():
    import time
    phrases, took = L.automaton(), []
    for n in (10_000, 80_000):
        begin = time.process_time()
        row = L.scan(b"cc by nc " * n, phrases)
        took.append(time.process_time() - begin)
        assert row[:4] == (3 * n, n, 0, 3 * n - 3)
    assert took[1] < 24 * took[0] + 0.5
