import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from shoplens.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def test_segments_give_the_library_ids():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", " ", "'s", "1", "é", "!", "<|endoftext|>", "　",
             "\x1c", "\x85", "word", "The", "\r\n", " \n", "\U0001f642", "​", "ß", "١"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(3000)]
    texts.append("long " * 5000 + "x" * 3000)
    want = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids(b) for b in tokens.encode_all(PATH, texts)] == want
    assert [ids(b) for b in tokens.encode_all(PATH, texts, RANKS)] == want


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_SEGMENTS", 50)
    library = Tokenizer.from_file(PATH)
    enc = tokens.SegmentEncoder(PATH, RANKS)
    texts = [" ".join(f"w{k * 7 + j}" for j in range(20)) for k in range(40)]
    for t in texts:
        assert ids(enc.encode([t])[0]) == library.encode(t, add_special_tokens=False).ids
        assert len(enc.inner) <= 50 + 21 and len(enc.inner.previous) <= 50 + 21


def test_plain_parts_are_one_call(monkeypatch):
    """Words that never repeat cost no call each, wherever the text is cut."""
    enc = tokens.SegmentEncoder(PATH, RANKS)
    library, calls, ranks = Tokenizer.from_file(PATH), [], enc.ranks
    enc.ranks = lambda text: calls.append(text) or ranks(text)
    text = " ".join(f"zq{k}x" for k in range(3000))
    assert ids(enc.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids
    assert "".join(calls) == text and len(calls) <= len(text) // tokens.PART_CHARS + 1
    mixed = text[:9000] + " l\u2019\u00e9t\u00e9  \n\n \U0001f642 <|endoftext|>\tend " + text[:9000] + "y" * 9000
    want = library.encode(mixed, add_special_tokens=False).ids
    for size in (1, 10, 500, tokens.PART_CHARS):
        monkeypatch.setattr(tokens, "PART_CHARS", size)
        assert "".join(enc.parts(mixed)) == mixed
        assert ids(enc.encode([mixed, ""])[0]) == want


def test_memo_of_mixed_parts_stays_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_SEGMENTS", 50)
    library = Tokenizer.from_file(PATH)
    enc = tokens.SegmentEncoder(PATH, RANKS)
    for k in range(40):
        text = " ".join(f"w{k * 7 + j}\u2019s" for j in range(20))
        assert ids(enc.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids
        assert len(enc.inner) <= 50 + 21 and len(enc.inner.previous) <= 50 + 21


def test_byte_batches_keep_order_and_balance():
    texts = ["x" * n for n in (5, 3000, 10, 10, 0, 9000, 1)]
    got = list(tokens.byte_batches(texts, 1000))
    assert [t for b in got for t in b] == texts
    assert all(len(b) == 1 or sum(map(len, b)) <= 1000 for b in got)


def test_counts(docs, rows, no_docs):
    library = Tokenizer.from_file(PATH)
    wide = docs.withColumn("hash", F.lit(1)).withColumn("n_tokens_old", F.lit("x"))
    got = sorted(((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit)
                  for r in tokens.count_tokens(wide).collect()))
    want = []
    for r in rows:
        n = len(library.encode(r[1] or "", add_special_tokens=False).ids)
        want.append((r[0] is None, r[0] or 0, len((r[1] or "").encode()), n, n > 512))
    assert got == sorted(want)
    assert tokens.count_tokens(no_docs).count() == 0
