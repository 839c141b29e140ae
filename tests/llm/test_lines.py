import random

from pyspark.sql import functions as F

from titleflow.llm import lines as L
from titleflow.llm.queries import op6_line_dedup


def brute_shingles(line, lookahead=4):
    w = line.split(" ")
    return {(x, *w[i + 1:i + 2], *(y[:lookahead] for y in w[i + 2:i + 3])) for i, x in enumerate(w)}


def brute_components(rows, similarity=0.8):
    """(doc, pos) -> (first doc, first pos) by comparing all pairs of distinct lines."""
    places, text = [], {}
    for doc, t in rows:
        for pos, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\n\r\x0b\x0c"):
                places.append((doc, pos))
                text[doc, pos] = line
    distinct = sorted(set(text.values()))
    sets = {x: brute_shingles(x) for x in distinct}
    label = {x: x for x in distinct}
    changed = True
    while changed:
        changed = False
        for x in distinct:
            for y in distinct:
                common = len(sets[x] & sets[y])
                if x != y and common >= similarity * (len(sets[x]) + len(sets[y]) - common) and label[x] != label[y]:
                    label[x] = label[y] = min(label[x], label[y])
                    changed = True
    first = {}
    for p in sorted(places):
        first.setdefault(label[text[p]], p)
    return {p: first[label[text[p]]] for p in places}


def made_rows(seed=3):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(r.randint(2, 9)))
    base = [" ".join(word() for _ in range(r.randint(1, 60))) for _ in range(40)]
    rows = []
    for doc in range(60):
        own = []
        for _ in range(r.randint(0, 8)):
            line = r.choice(base).split(" ")
            for _ in range(r.choice([0, 0, 1, 2])):
                line[r.randrange(len(line))] = word()
            own.append(r.choice(["", "  ", "\t"]) if r.random() < 0.2 else " ".join(line))
        rows.append((doc, "\n".join(own)))
    return rows


def test_components_against_brute_force(spark):
    rows = made_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc, r.pos): (r["first"].doc, r["first"].pos) for r in L.line_components(docs).collect()}
    want = brute_components(rows)
    assert got.keys() == want.keys()
    missed = [p for p in want if got[p] != want[p]]
    assert len(missed) <= 0.005 * len(want), missed  # banding finds 99.8 % at the threshold itself
    kept = {(r.doc, r.pos) for r in L.line_components(docs).where("kept").collect()}
    assert kept == {p for p in got if got[p] == p}


def test_links_in_crowded_buckets(spark):
    """Lines that share half of their words crowd the buckets without being
    similar; the similar ones among them are found all the same."""
    r = random.Random(9)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    passage = [word() for _ in range(30)]
    rows = []
    for doc in range(0, 80, 2):
        own = passage + [word() for _ in range(30)]
        rows.append((doc, " ".join(own)))
        own[r.randrange(60)] = word()
        rows.append((doc + 1, " ".join(own)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(x.doc, x.pos): (x["first"].doc, x["first"].pos) for x in L.line_components(docs).collect()}
    want = brute_components(rows)
    assert want == {(d, 0): (d - d % 2, 0) for d in range(80)} and got == want


def test_crowded_buckets_lose_no_link(spark, monkeypatch):
    """Lines that leave out other parts of a template have no shingle of
    their own, so that nearly all of them meet in crowded buckets only."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    parts = [[word() for _ in range(8)] for _ in range(24)]
    rows = [(doc, " ".join(w for p in sorted(r.sample(range(24), r.randint(16, 20))) for w in parts[p])) for doc in range(60)]
    rows += [(doc, t + " " + word()) for doc, t in made_rows(4)[:20]]
    rows = list(enumerate(t for _, t in rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(L, "CROWD", 2)
    got = {(x.doc, x.pos): (x["first"].doc, x["first"].pos) for x in L.line_components(docs).collect()}
    assert got == brute_components(rows)


def test_few_pairs_are_compared_that_are_not_similar(spark, monkeypatch):
    """Of the pairs that share seldom shingles the marks leave the similar ones and few more."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(7))
    parts = [[word() for _ in range(8)] for _ in range(24)]
    rows = [(doc, " ".join(w for p in sorted(r.sample(range(24), r.randint(16, 20))) for w in parts[p])) for doc in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [brute_shingles(t) for _, t in rows]
    similar = sum(len(s & t) >= 0.8 * len(s | t) for i, s in enumerate(sets) for t in sets[:i])
    compared, exact = [], L._similar
    monkeypatch.setattr(L, "CROWD", 2)
    monkeypatch.setattr(L, "_similar", lambda pairs, *more: (compared.append(pairs.count()), exact(pairs, *more))[1])
    L.line_components(docs).count()
    assert sum(compared) <= 3 * similar + 20, (compared, similar)


def test_marks_leave_every_similar_pair(spark):
    lines = sorted({line for _, t in made_rows(6) for line in t.split("\n") if line.strip()} | {"b", "a b", "x " * 40})
    texts = spark.createDataFrame(list(enumerate(lines)), "l1 long, line string")
    pairs = [(i, j) for i in range(len(lines)) for j in range(i)]
    sets = [brute_shingles(x) for x in lines]
    similar = {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    left = L._sifted(spark.createDataFrame(pairs, "a long, b long"), L._marks(texts, 4, None), 0.8)
    left = {(p.a, p.b) for p in left.collect()}
    assert similar and similar <= left and len(left) < 0.5 * len(pairs)


def test_documents_lose_repeated_lines_only(spark):
    a, b = "one line of some ten words that stands here twice", "another line altogether with its own words in it"
    rows = [(2, f"{a}\n\n{b}", 0, "x"), (1, f"  \n{a}", 0, "x"), (3, a, 0, None), (4, None, 0, "x"), (5, "", 0, "x"),
            (6, "\n \n", 0, "x"), (None, f"{b}\ntail", 0, "x"), (7, "w\nw", 0, "x"), (7, "w\nw", 0, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, line string")
    out = L.dedup_lines(docs, chars="n_chars")
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in out.collect()), key=str)
    assert got == sorted([(2, f"\n{b}", 1 + len(b)), (1, f"  \n{a}", 0), (4, None, 0), (5, "", 0), (6, "\n \n", 0),
                          (None, "tail", 4), (7, "w", 1), (7, "w", 1)], key=str)
    assert L.dedup_lines(docs.limit(0)).count() == 0


def test_very_long_line(spark):
    line = " ".join(f"w{i}" for i in range(30_000))
    docs = spark.createDataFrame([(1, line), (2, line + " more"), (3, "z" * 100_000)], "doc_id long, text string")
    assert sorted(r.doc_id for r in L.dedup_lines(docs).collect()) == [1, 3]


def character_shingles(line, width):
    return {line[i:i + width] for i in range(max(1, len(line) - width + 1))}


def test_one_changed_character_in_short_lines(spark):
    """A changed character costs ``width`` of a line's shingles, not three of its words."""
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(4, 8)))
    rows = []
    for doc in range(0, 120, 2):
        line = " ".join(word() for _ in range(r.randint(16, 26)))
        at = r.randrange(len(line))
        rows += [(doc, line), (doc + 1, line[:at] + "Z" + line[at + 1:])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for width in (5, L.WIDTH):
        sets = [character_shingles(t, width) for _, t in rows]
        alike = {d for d in range(0, 120, 2) if len(sets[d] & sets[d + 1]) >= 0.8 * len(sets[d] | sets[d + 1])}
        found = {x["first"].doc for x in L.line_components(docs, width=width).where("not kept").collect()}
        assert len(alike) >= 50 and found == alike


def test_registered_query_takes_character_shingles(spark, tmp_path):
    line = "these twenty words or so make up a single line of text in which one typo alone leaves most of it alike as before"
    docs = spark.createDataFrame([(1, line), (2, line.replace("typo", "tyqo"))], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert [r.kept for r in op6_line_dedup(spark, str(tmp_path)).orderBy("doc_id").collect()] == [True, False]


def test_character_shingles_at_every_position(spark):
    cases = ["", "ab", "abcde", "abcdef", "aaaaaaaaa", "a\rb c\td\u2028e", "x😀y😀😀zé€ w", "😀😀😀😀😀😀"]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "i long, line string")
    hashed = lambda t: spark.createDataFrame(
        [(x,) for x in character_shingles(t, 5)], "x string").selectExpr("xxhash64(x) h").collect()
    for r in rows.select("line", L.shingles(F.col("line"), width=5).alias("s")).collect():
        assert len(r.s) == len(set(r.s)) and set(r.s) == {x.h for x in hashed(r.line)}, r.line


def test_no_python_on_executors(spark, monkeypatch):
    plans, stored = [], L.stored
    monkeypatch.setattr(L, "CROWD", 2)
    monkeypatch.setattr(L, "stored", lambda df: (plans.append(df._jdf.queryExecution().toString()), stored(df))[1])
    docs = spark.createDataFrame(made_rows(8)[:20], "doc_id long, text string")
    L.line_components(docs, width=L.WIDTH).count()
    assert len(plans) > 10 and not [p for p in plans if "InArrow" in p or "Python" in p]


def test_two_frequent_shingles_make_no_pair(spark):
    """Lines that share two neighbouring hashes only are in no bucket; three, or two of a short line, are."""
    rows = [(i, [1, 2] + [100 * i + j for j in range(1, 17)]) for i in range(1, 41)]
    rows += [(101, [5, 6, 7, 8, 9]), (102, [5, 6, 8, 9]), (103, [-3, -2, -1, *range(7000, 7015)]), (104, [-3, -2, -1, *range(8000, 8015)])]
    signed = spark.createDataFrame(rows, "l1 long, signature array<int>")
    pairs, crowd, _ = L._proposals(L._keys(signed))
    assert {tuple(p) for p in pairs.collect()} == {(102, 101), (104, 103)} and crowd.isEmpty()


def test_lines_that_are_not_utf8_stay_apart(spark):
    """Lines are compared byte by byte, also where their bytes are no characters."""
    docs = spark.sql("select * from values (1L, cast(X'61FF62' as string)), (2L, cast(X'61FE62' as string)), "
                     "(3L, cast(X'61FF620A63' as string)) as t(doc_id, text)")
    got = {(x.doc, x.pos): x["first"].doc for x in L.line_components(docs, width=L.WIDTH).collect()}
    assert got == {(1, 0): 1, (2, 0): 2, (3, 0): 1, (3, 1): 3}


def minhash_order(line, width, hashed):
    """Distinct shingles that start with a character of FIRST by hash, then the others by hash."""
    sets = character_shingles(line, width) if len(line) >= width else set()
    first = sorted({hashed[x] for x in sets if x[0] in L.FIRST})
    return first + sorted({hashed[x] for x in sets if x[0] not in L.FIRST})


def test_one_minhash_order_for_short_long_and_divided_lines(spark, monkeypatch):
    """Lines with enough shingles of the first class, with few and with none get the first ones of the same order."""
    r = random.Random(2)
    word = lambda n: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    cases = ["", "ab", "zzzzzz zzzzzzz", "a\rb c\td\u2028e rest", "x😀y😀😀zé€ w d😀😀😀😀c", "Привет, мир и все остальные слова", "z" * 300]
    cases += [" ".join(word(r.randint(2, 9)) for _ in range(n)) for n in (4, 8, 15, 30, 90)]
    every = sorted({x for t in cases for x in character_shingles(t, 6)})
    hashed = {x.s: x.h for x in spark.createDataFrame([(x,) for x in every], "s string").selectExpr("s", "hash(s) h").collect()}
    rows = spark.createDataFrame([(t,) for t in cases], "line string")
    for block in (L.BLOCK, 50):
        monkeypatch.setattr(L, "BLOCK", block)
        for x in L.with_signature(rows, 12, 4, 6).collect():
            assert x.signature == minhash_order(x.line, 6, hashed)[:12], (block, x.line)


def test_lines_are_hashed_once_for_a_comparison(spark, monkeypatch):
    """The sets of a pair are steps of their own; no filter below repeats them."""
    plans, stored = [], L.stored
    monkeypatch.setattr(L, "stored", lambda df: (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), stored(df))[1])
    texts = spark.createDataFrame([(1, "these words make a line"), (2, "these words make a line!"), (3, "others")], "l1 long, line string")
    pairs = spark.createDataFrame([(2, 1), (3, 1)], "a long, b long")
    assert [tuple(p) for p in L._similar(pairs, texts, 0.8, 4, 9).collect()] == [(2, 1)]
    assert len(plans) == 1 and plans[0].count("substring(") == 2


def test_marks_of_characters_leave_every_similar_pair(spark):
    lines = sorted({line[:r] for _, t in made_rows(6) for line in t.split("\n") for r in (70, 73, 400) if len(line) > 8 and line.strip()})
    texts = spark.createDataFrame(list(enumerate(lines)), "l1 long, line string")
    pairs = [(i, j) for i in range(len(lines)) for j in range(i)]
    sets = [character_shingles(x, L.WIDTH) for x in lines]
    similar = {(i, j) for i, j in pairs if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    left = L._sifted(spark.createDataFrame(pairs, "a long, b long"), L._marks(texts, 4, L.WIDTH), 0.8)
    left = {(p.a, p.b) for p in left.collect()}
    assert similar and similar <= left and len(left) < 0.5 * len(pairs)
