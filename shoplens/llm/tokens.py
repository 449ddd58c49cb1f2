"""Token counts: batch encoding in an Arrow function that returns lengths.

Texts go to the tokenizer library in sub-batches balanced by bytes.  A text
is cut only at safe boundaries: in front of a single white-space character
that stands between two other characters.  The tokenizer's own first step
starts a new piece at each of these places, so the ids of a text are the
concatenated ids of its segments and the whole text is always counted.
Segments repeat (they are words), so each distinct one is encoded once per
worker and kept in a memo of bounded size.  Where merge ranks are given, texts
are first cut into parts at such boundaries; a part of plain Latin text goes
through the rank encoder in one call, any other part by its segments.

Defined results: a null text counts as empty (0 tokens, 0 bytes); special
token strings inside a text become that special token, the library's
default; rows are never merged, so repeated rows repeat their counts; other
columns pass through untouched.  The result columns must not exist yet.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BATCH_BYTES = 1 << 20        # texts handed to the tokenizer at once
MEMO_SEGMENTS = 100_000      # distinct segments in each half of a worker's memo
MEMO_SEGMENT_CHARS = 64      # longer segments are encoded each time
PART_CHARS = 4096            # a part ends at the first boundary from here on

_SPACES = re.compile(r"\s\s")
_SAFE_CUT = re.compile(r"(?<=\S)(?=\s\S)")
# ASCII and the Latin blocks: character classes that no Unicode version moves.
_PLAIN = re.compile(r"[\n -~\u00a1-\u00ac\u00ae-\u024f]*\Z")


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class _Memo(dict):
    """Segment -> ids; an unknown segment is looked up in the previous half
    of the memo and else encoded."""

    def __init__(self, encode, previous: dict | None = None):
        super().__init__()
        self.encode, self.previous = encode, previous or {}

    def __missing__(self, key: str) -> bytes:
        ids = self.previous.get(key)
        if ids is None:
            ids = self.encode(key)
        if len(key) <= MEMO_SEGMENT_CHARS:
            self[key] = ids
        return ids

    def next(self) -> _Memo:
        """This memo, or an empty one in front of it once it is full."""
        return _Memo(self.encode, dict(self)) if len(self) > MEMO_SEGMENTS else self


class SegmentEncoder:
    """Encodes whole texts as little-endian unsigned 32-bit ids.

    ``path`` is the tokenizer file.  ``ranks`` may name the same vocabulary
    as merge ranks; parts and segments of plain Latin text then go through the
    rank encoder, which gives the same ids faster, and all others through the
    tokenizer file.
    """

    def __init__(self, path: str, ranks: str | None = None):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.ranks = _rank_encoder(ranks) if ranks else None
        self.first = _Memo(self._one)                 # segment that begins a text
        self.inner = _Memo(self._one_inside)          # segment after a boundary

    def _batch(self, segments: list[str]) -> list[bytes]:
        out = self.tokenizer.encode_batch_fast(segments, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in out]

    def _plain(self, text: str) -> bool:
        """Whether the rank encoder gives the library's ids of ``text``."""
        return bool(self.ranks and (text.isascii() or _PLAIN.match(text))
                    and not any(s in text for s in self.special))

    def _ranked(self, text: str) -> bytes:
        return array("I", self.ranks(text)).tobytes()

    def _one(self, segment: str) -> bytes:
        return self._ranked(segment) if self._plain(segment) else self._batch([segment])[0]

    def _one_inside(self, key: str) -> bytes:
        return self._one(self._inside(key))

    @staticmethod
    def _inside(key: str) -> str:
        return key if key[:1].isspace() else " " + key

    @staticmethod
    def segments(text: str) -> list[str]:
        """Segments of a text.  Past the first one, a segment stands for
        itself if it begins with white space, else for a space plus itself."""
        if _SPACES.search(text) is None:
            return text.replace("\n", " \n").split(" ")
        cut = _SAFE_CUT.split(text)
        return cut[:1] + [s[1:] if s[0] == " " else s for s in cut[1:]]

    @staticmethod
    def parts(text: str) -> Iterator[str]:
        """Consecutive parts of a text, cut at safe boundaries."""
        at = 0
        while len(text) - at > PART_CHARS and (cut := _SAFE_CUT.search(text, at + PART_CHARS)):
            yield text[at:cut.start()]
            at = cut.start()
        yield text[at:]

    def _part(self, part: str) -> bytes:
        return self._ranked(part) if self._plain(part) else self._joined(self.segments(part))

    def _joined(self, segments: list[str]) -> bytes:
        return self.first[segments[0]] + b"".join(map(self.inner.__getitem__, segments[1:]))

    def encode(self, texts: list[str]) -> list[bytes]:
        self.first, self.inner = self.first.next(), self.inner.next()
        if self.ranks:
            return [b"".join(map(self._part, self.parts(t))) for t in texts]
        cut = [self.segments(t) for t in texts]
        self._learn(set().union(*(s[1:] for s in cut)))
        return [self._joined(s) for s in cut]

    def _learn(self, keys: set[str]) -> None:
        """Encode the unknown segments in one call of the library."""
        memo = self.inner
        new = [k for k in keys - memo.keys()
               if len(k) <= MEMO_SEGMENT_CHARS and k not in memo.previous]
        memo.update(zip(new, self._batch([self._inside(k) for k in new])))


def _rank_encoder(path: str):
    import base64

    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(t): int(n) for t, n in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=ranks, special_tokens={}).encode_ordinary


_ENCODERS: dict[tuple, SegmentEncoder] = {}


def encoder(path: str, ranks: str | None = None) -> SegmentEncoder:
    """One encoder per tokenizer file and Python worker."""
    if (path, ranks) not in _ENCODERS:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
        _ENCODERS[path, ranks] = SegmentEncoder(path, ranks)
    return _ENCODERS[path, ranks]


def byte_batches(texts: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Consecutive sub-batches of about ``limit`` bytes, one text at least."""
    batch, size = [], 0
    for t in texts:
        if batch and size + len(t) > limit:
            yield batch
            batch, size = [], 0
        batch.append(t)
        size += len(t)
    if batch:
        yield batch


def encode_all(path: str, texts: list[str], ranks: str | None = None) -> Iterator[bytes]:
    enc = encoder(path, ranks)
    for batch in byte_batches(texts):
        yield from enc.encode(batch)


def n_tokens(text: Column, path: str) -> Column:
    """Column of token counts of a string column."""

    def count(series: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in series:
            texts = ["" if t is None else t for t in s.tolist()]
            yield pd.Series([len(b) // 4 for b in encode_all(path, texts)], dtype="int64")

    return F.pandas_udf(count, "long")(text)


def count_tokens(df: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 512,
                 text: str = "text") -> DataFrame:
    """``df`` plus n_bytes, n_tokens and over_limit (n_tokens > ``limit``)."""
    return (df
            .withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
            .withColumn("n_tokens", n_tokens(F.col(text), tokenizer_path(tokenizer)))
            .withColumn("over_limit", F.col("n_tokens") > limit))
