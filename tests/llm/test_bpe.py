import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from titleflow.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, bpe.read_ranks(RANKS).splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def made_texts():
    r = random.Random(2)
    some = ["", " ", "\n\n \t x", "a" * 400, "ab" * 100, "don't I'LL we've", "<|endoftext|> x", "日本語 한국어 🎉 é",
            "\x00\x1c\x85  y　z", "٣٤ ½ Ⅷ ²", "it's  spaced   out\r\n"]
    mixed = ["".join(chr(r.choice([r.randrange(32, 127), r.randrange(0xA0, 0x800), r.randrange(0x1F300, 0x1F700)]))
                     for _ in range(150)) for _ in range(20)]
    return some + mixed


def test_ids_equal_the_library(library):
    encoder = bpe.Encoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    for text, (ids, n, raw) in zip(made_texts(), encoder.encode(made_texts()), strict=True):
        want = library.encode_ordinary(text)
        assert ids == ",".join(map(str, want)) and n == len(want)
        assert raw == text.encode()


def test_long_piece_goes_on_over_several_queries(library, monkeypatch):
    monkeypatch.setattr(bpe, "STEP_ROWS", 2_000)
    encoder = bpe.Encoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(600))
    [(ids, _, raw)] = encoder.encode([text])
    assert ids == ",".join(map(str, library.encode_ordinary(text))) and raw == text.encode()


def test_cache_is_emptied_without_changing_results(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    encoder = bpe.Encoder(bpe.read_ranks(RANKS), public_tokenizers.PATTERN)
    for _ in range(2):
        for text in ("one two three four five", "two six seven", "one"):
            [(ids, _, _)] = encoder.encode([text])
            assert ids == ",".join(map(str, library.encode_ordinary(text)))


def test_documents(spark, library):
    rows = [(i, t, "x", 5) for i, t in enumerate(made_texts())] + [(900, None, None, None), (900, None, None, None),
                                                                   (None, "same", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string, n_tokens long")
    out = bpe.encode_documents(docs, RANKS, public_tokenizers.PATTERN, with_ids=True)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids, r.decoded)
                 for r in out.collect())
    want = []
    for doc, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        sha = lambda b: hashlib.sha256(b).hexdigest()
        want.append((doc is None, doc, len(ids), sha(",".join(map(str, ids)).encode()), sha((text or "").encode()),
                     ids, text or ""))
    assert got == sorted(want)
    assert bpe.encode_documents(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
