"""Line deduplication by content-defined chunks of lines.

A run of consecutive lines is a passage if it has at least ``MIN_LINES``
lines with text and ``MIN_WORDS`` words, or more than ``LONG_LINE_WORDS``
words.  Lines of a passage that also stands at an earlier place of the corpus
are removed; places are ordered by (doc_id, text hash, line).

* A rolling hash over the line hashes chooses boundaries.  It rolls over
  ``ROLL_LINES`` lines, one, so a boundary depends on nothing but its line
  and moves with it, whatever stands around.  The more words a line has, the
  likelier it is a boundary: a line of ``FULL_WORDS`` words always is.
* A chunk reaches from one boundary to the next, both included, so it always
  has several lines; a line of more than ``LONG_LINE_WORDS`` words is a chunk
  by itself as well.
* Chunk hashes are counted over the corpus; chunks whose hash repeats are
  grouped by their bytes, and only equal bytes count as a repetition.
* A repeated chunk is a seed: it is extended line by line, in both directions,
  as far as the bytes around it equal those around its first place.  Beyond
  the next boundary there is another chunk to find the same, so a chunk
  carries the lines up to there and no more.
* Seeds and their extensions that meet in a document and in the document of
  their first place are one run.  Runs that are passages are removed.

What this finds always stands at an earlier place.  It can miss a run that
has fewer than two boundaries, which takes short lines, and the lines at a
run's edge if the seed next to them has its first place in yet another text:
the README has measured figures.

A fixed-size bitmap of the repeated hashes decides which chunks are stored
with their bytes, so unique text is not moved.

Blank lines count for nothing and are not compared: they belong to the line
with text before them (those at the top to the first one) and go with it.

Defined results: a null text stays null, an empty one empty; a text whose
lines are all removed becomes empty; rows equal in doc_id and text are one
document and stay equal; a passage that repeats inside one document keeps its
first place, also if the places overlap (a line repeated many times in a row
is left once); a null doc_id orders before all others; other columns pass
through, but a column named like the count is replaced; an empty table gives
no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import bitmap
from shoplens.llm.common import dealt, document_name, materialize, slices

MIN_LINES = 2
MIN_WORDS = 10              # shorter passages repeat by chance
LONG_LINE_WORDS = 50        # a single line of more words is a passage
ROLL_LINES = 1
FULL_WORDS = 5              # a line of so many words is a boundary
MAX_LINES = 32              # of a chunk: beyond, a boundary is set
_MIX = np.uint64(0x9E3779B97F4A7C15)


def chunks(lines: list[bytes]) -> list[tuple[int, int]]:
    """(first line, end line) of each line with text and the blank lines that
    belong to it, in order and without gaps."""
    starts = [i for i, line in enumerate(lines) if line.strip()] or [0]
    starts[0] = 0
    return list(zip(starts, [*starts[1:], len(lines)])) if lines else []


def _text_lines(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(the lines with text, their words, lines of each text) of some texts."""
    lines, words, lengths = [], [], []
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
        before = len(lines)
        for line in raw:
            count = len(line.split())
            if count:
                lines.append(line)
                words.append(count)
        lengths.append(len(lines) - before)
    return lines, np.array(words, dtype="int64"), np.array(lengths, dtype="int64")


def _line_hashes(lines: list[bytes]) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh64_intdigest, lines), "uint64", len(lines))


def boundaries(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Which lines are boundaries: the rolled hash against the line's words."""
    rolled = hashes * _MIX
    for _ in range(ROLL_LINES - 1):
        rolled = rolled + np.concatenate((np.zeros(1, "uint64"), rolled[:-1] * _MIX))
    share = (rolled ^ rolled >> np.uint64(29)) >> np.uint64(40)       # 24 bits
    return share < (np.minimum(words, FULL_WORDS) << 24) // FULL_WORDS


class Cut:
    """The chunks of some texts that lie one after the other.

    ``first`` and ``last``: their first and last line (of all lines);
    ``before`` and ``after``: how far the lines around a chunk belong to its
    context, exclusive of the next boundary; ``owner``: the text.
    """

    def __init__(self, hashes: np.ndarray, words: np.ndarray, lengths: np.ndarray):
        high = np.cumsum(lengths)
        low = high - lengths
        mark = boundaries(hashes, words)
        cut = mark.copy()
        filled = lengths > 0
        cut[low[filled]] = cut[high[filled] - 1] = True     # both ends of a text
        at = np.flatnonzero(cut)
        wide = np.flatnonzero(np.diff(at) > MAX_LINES)
        if len(wide):
            cut[np.concatenate([np.arange(at[k] + MAX_LINES, at[k + 1], MAX_LINES) for k in wide])] = True
            at = np.flatnonzero(cut)
        owner = np.searchsorted(high, at, "right")
        pair = np.flatnonzero(owner[:-1] == owner[1:])
        long = np.flatnonzero(words[at] > LONG_LINE_WORDS)
        self.low, self.high = low, high
        # An end of a text that is no boundary itself is context of its neighbour.
        self._before = np.where(mark[at], at + 1, at)       # where the context after `at` begins
        self._after = np.where(mark[at], at, at + 1)        # where the context before `at` ends
        inner = np.arange(len(at))
        previous, following = np.maximum(inner - 1, 0), np.minimum(inner + 1, len(at) - 1)
        begin = np.where(owner[previous] == owner, self._before[previous], at)
        begin[previous == inner] = at[previous == inner]
        end = np.where(owner[following] == owner, self._after[following], at + 1)
        end[following == inner] = at[following == inner] + 1
        left, right = np.concatenate((pair, long)), np.concatenate((pair + 1, long))
        self.owner = owner[left]
        self.first, self.last = at[left], at[right]
        self.before = np.minimum(begin[left], self.first)
        self.after = np.maximum(end[right], self.last + 1)


def _chunk_hashes(lines: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """One hash per chunk from the hashes of its lines."""
    out = np.zeros(len(first), dtype="uint64")
    for k in range(int((last - first).max(initial=-1)) + 1):
        at = np.flatnonzero(first + k <= last)
        h = (out[at] + lines[first[at] + k]) * _MIX
        out[at] = h ^ h >> np.uint64(29)
    return out


def _chunk_rows(docs: DataFrame, repeated: np.ndarray | None) -> DataFrame:
    """The chunks of ``docs(doc_id, text_hash, text)``: all hashes, or, given
    a bitmap, the chunks whose hash may be in it with their bytes and the
    lines around them."""
    shared = (None if repeated is None else
              docs.sparkSession.sparkContext.broadcast(repeated))     # of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 200):
            lines, words, lengths = _text_lines(batch.column("text").to_pylist())
            line_hashes = _line_hashes(lines)
            cut = Cut(line_hashes, words, lengths)
            hashes = _chunk_hashes(line_hashes, cut.first, cut.last)
            if shared is None:
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view("int64"))], ["hash"])
                continue
            at = np.flatnonzero(bitmap.contains(shared.value, hashes))
            take = pa.array(cut.owner[at])

            def body(a: np.ndarray, b: np.ndarray) -> pa.Array:
                return pa.array([b"\n".join(lines[i:j]) for i, j in zip(a[at].tolist(), b[at].tolist())],
                                pa.binary())

            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[at].view("int64")),
                 batch.column("doc_id").take(take), batch.column("text_hash").take(take),
                 pa.array((cut.first - cut.low[cut.owner])[at].astype("int32")),
                 pa.array((cut.last - cut.low[cut.owner])[at].astype("int32")),
                 body(cut.first, cut.last + 1), body(cut.before, cut.first),
                 body(cut.last + 1, cut.after)],
                ["hash", "doc_id", "text_hash", "line", "last", "body", "before", "after"])

    return docs.mapInArrow(run, "hash long" if shared is None else (
        "hash long, doc_id long, text_hash long, line int, last int, body binary, before binary, "
        "after binary"))


def _common(a: list[bytes], b: list[bytes]) -> int:
    """How many lines two lists have in common from their start."""
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _context(text: bytes) -> list[bytes]:
    return text.split(b"\n") if text else []


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of seeds with both contexts -> (start, end) of the equal lines."""
    for batch in slices(batches, 1000):
        rows = {c: batch.column(c).to_pylist() for c in
                ("line", "last", "before", "after", "first_before", "first_after")}
        start, end = [], []
        for line, last, before, after, fb, fa in zip(*rows.values()):
            start.append(line - _common(_context(before)[::-1], _context(fb)[::-1]))
            end.append(last + 1 + _common(_context(after), _context(fa)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(start, pa.int32()),
             pa.array(end, pa.int32()), batch.column("first_id"), batch.column("first_hash"),
             pa.array([a - b for a, b in zip(rows["line"], batch.column("first_line").to_pylist())],
                      pa.int32())],
            ["doc_id", "text_hash", "start", "end", "first_id", "first_hash", "shift"])


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, gone): per document, the places of its chunks that
    stand at an earlier place, with their extensions: (start, end, first_id,
    first_hash, shift)."""
    keyed = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"),
                        "text")
    hashes = materialize(_chunk_rows(keyed, None).groupBy("hash")
                         .agg(F.count("*").alias("n")).where("n > 1").select("hash"), "repeated")
    found = materialize(_chunk_rows(keyed, bitmap.build(hashes, "hash")), "chunks")
    place = F.struct("doc_id", "text_hash", "line")
    bodies = materialize(found.groupBy("hash", "body").agg(
        F.min(F.struct("doc_id", "text_hash", "line", "before", "after")).alias("first"),
        F.max(place).alias("last_place")), "first")
    # A hash of one body needs no bytes to find it again; others are joined by them.
    per_hash = materialize(bodies.groupBy("hash").agg(F.count("*").alias("bodies")), "per_hash")
    own = F.struct("first.doc_id", "first.text_hash", "first.line")
    moved = (bodies.where(~own.eqNullSafe(F.col("last_place"))).join(dealt(per_hash), "hash")
             .select("hash", "body", "bodies", F.col("first.doc_id").alias("first_id"),
                     F.col("first.text_hash").alias("first_hash"), F.col("first.line").alias("first_line"),
                     F.col("first.before").alias("first_before"), F.col("first.after").alias("first_after")))
    moved = materialize(moved, "moved")
    seeds = (found.drop("body").join(dealt(moved.where("bodies = 1").drop("body", "bodies")), "hash")
             .unionByName(found.join(dealt(moved.where("bodies > 1").drop("bodies")), ["hash", "body"]).drop("body"))
             .where(~place.eqNullSafe(F.struct(F.col("first_id"), F.col("first_hash"), F.col("first_line")))))
    ranges = seeds.mapInArrow(
        _extended, "doc_id long, text_hash long, start int, end int, first_id long, first_hash long, shift int")
    return ranges.groupBy("doc_id", "text_hash").agg(F.collect_set(
        F.struct("start", "end", "first_id", "first_hash", "shift")).alias("gone"))


def without(text: str | None, gone: list[tuple] | None) -> str | None:
    """The text without the passages among the places (start, end, first_id,
    first_hash, shift) of ``repeated_chunks``."""
    if text is None or gone is None or len(gone) == 0:
        return text
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    units = chunks(lines)
    words = np.concatenate(([0], np.cumsum([len(b" ".join(lines[a:b]).split()) for a, b in units])))
    runs: list[list] = []
    for start, end, *first in sorted(gone, key=lambda g: (*(str(x) for x in g[2:]), g[0], g[1])):
        if runs and runs[-1][2] == first and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end, first])
    keep = np.ones(len(units), dtype=bool)
    for start, end, _ in runs:
        count = words[end] - words[start]
        if count > LONG_LINE_WORDS or end - start >= MIN_LINES and count >= MIN_WORDS:
            keep[start:end] = False
    kept = [x for (a, b), k in zip(units, keep.tolist()) if k for x in lines[a:b]]
    return b"\n".join(kept).decode("utf-8", "surrogatepass")


def dedup_lines(docs: DataFrame, count: str = "removed_chunks") -> DataFrame:
    """``docs`` with the repeated passages taken out of ``text``, plus
    ``removed_chunks`` (how many of its chunks stand at an earlier place).

    Only documents that may lose something are joined with their lists; the
    texts of all others are not moved.
    """
    gone = materialize(repeated_chunks(docs).select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("gone").alias("_gone"),
        document_name(F.col("doc_id"), F.col("text_hash")).alias("_name")), "gone")

    @F.pandas_udf("string")
    def cut(texts: pd.Series, lists: pd.Series) -> pd.Series:
        return pd.Series([without(t, None if g is None else [
            (x["start"], x["end"], x["first_id"], x["first_hash"], x["shift"]) for x in g])
            for t, g in zip(texts.tolist(), lists.tolist())], dtype=object)

    own = F.xxhash64(docs["text"])
    some, rest = bitmap.split(docs, document_name(docs["doc_id"], own), gone, "_name")
    columns = [c for c in docs.columns if c != count]
    joined = some.join(dealt(gone), some["doc_id"].cast("long").eqNullSafe(gone["_id"])
                       & F.xxhash64(some["text"]).eqNullSafe(gone["_hash"]), "left")
    touched = gone["_gone"].isNotNull()
    text = F.when(touched, cut(F.when(touched, some["text"]), gone["_gone"])).otherwise(some["text"])
    changed = joined.select(
        *[text.alias("text") if c == "text" else some[c] for c in columns],
        F.coalesce(F.size(gone["_gone"]), F.lit(0)).alias(count))
    return changed.unionByName(rest.select(*columns, F.lit(0).alias(count)))
