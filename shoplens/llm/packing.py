"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most ``capacity`` ids; the pieces are
packed into sequences.  For each sequence a bitset subset-sum dynamic
programme over the lengths still available finds the fullest combination
that contains the longest remaining piece; the combination is then removed.

The programme needs only how many pieces there are of each length, at most
``capacity`` numbers however large the corpus, and a combination is removed
as often as the counts allow at once: it stays the fullest one while its
pieces last, since removals never make a fuller one.  The plan is therefore
a bounded list of (combination, repeats).  Spark then numbers the pieces of
each length, and a piece's number picks its sequence and offset by binary
search in the plan.

Defined results: a null text is an empty document, one token (the end id);
a document longer than the capacity is cut into full pieces, and a shorter
piece, if one is left over, comes first; repeated rows are packed as often
as they occur; documents with a null id are packed like any other; an empty
table gives no rows.  Other columns are not carried.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm import tokens
from shoplens.llm.common import materialize, slices
from shoplens.llm.ordering import numbered

CAPACITY = 1024
END_ID = 2
RANK_BITS = 48      # pieces of one length are numbered below 2**48
PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long")


# -- pieces ---------------------------------------------------------------

def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; the first may be shorter."""
    head = n % capacity
    starts = ([0] if head else []) + list(range(head, n, capacity))
    return [(s, (starts + [n])[i + 1] - s) for i, s in enumerate(starts)]


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None,
           capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The token pieces of ``docs(doc_id, text)``, with their ids on request."""
    end = array("I", [END_ID]).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            doc_ids = batch.column("doc_id").to_pylist()
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            out: list[tuple] = []
            for doc_id, ids in zip(doc_ids, tokens.encode_all(tokenizer, texts, ranks)):
                ids += end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    part = ids[4 * start:4 * (start + length)]
                    out.append((doc_id, k, start, length, zlib.crc32(part), part))
            if out:
                cols = list(zip(*out))
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [pa.array(c, t) for c, t in zip(cols, kinds)]
                if with_ids:
                    flat = np.frombuffer(b"".join(cols[5]), "<u4").astype("int32")
                    ends = np.cumsum([0, *cols[3]], dtype="int32")
                    arrays.append(pa.ListArray.from_arrays(ends, flat))
                yield pa.RecordBatch.from_arrays(arrays, names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids
    schema = PIECES + ", ids array<int>" * with_ids
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


# -- plan -----------------------------------------------------------------

def fullest(counts: dict[int, int], room: int) -> dict[int, int]:
    """The fullest combination of available lengths within ``room``.

    ``reach`` is a bitset of the sums in reach.  Lengths are offered from
    the longest down, so that long pieces are used up first; a length that
    occurs many times is offered in doubling bundles.
    """
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((k for k in counts if k <= room and counts[k] > 0), reverse=True):
        left, bundle = min(counts[length], room // length), 1
        while left and not reach >> room & 1:
            n = min(bundle, left)
            steps.append((length, n, reach))
            reach = (reach | reach << (length * n)) & mask
            left -= n
            bundle *= 2
        if reach >> room & 1:
            break
    total, chosen = reach.bit_length() - 1, {}
    for length, n, before in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + n
            total -= length * n
    return chosen


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """[(pieces of each length in one sequence, how many such sequences)]."""
    left = {k: n for k, n in counts.items() if n > 0}
    out = []
    while left:
        longest = max(left)
        left[longest] -= 1
        combo = fullest(left, capacity - longest)
        left[longest] += 1
        combo[longest] = combo.get(longest, 0) + 1
        times = min(left[k] // m for k, m in combo.items())
        for k, m in combo.items():
            left[k] -= m * times
            if not left[k]:
                del left[k]
        out.append((combo, times))
    return out


def plan_table(steps: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """The plan as one row per (step, length), sorted by (length, first rank).

    Pieces of ``length`` with ranks first .. first + each * times - 1 go to
    the sequences sequence .. sequence + times - 1, ``each`` to a sequence,
    from ``offset`` on.
    """
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for combo, times in steps:
        offset = 0
        for length in sorted(combo, reverse=True):
            each = combo[length]
            rows.append((length, used.get(length, 0), each, sequence, offset))
            used[length] = used.get(length, 0) + each * times
            offset += each * length
        sequence += times
    rows.sort()
    cols = zip(*rows) if rows else [()] * 5
    return {n: np.array(c, dtype="int64")
            for n, c in zip(("length", "first", "each", "sequence", "offset"), cols)}


# -- assignment -----------------------------------------------------------

def assign(placed: DataFrame, table: dict[str, np.ndarray]) -> DataFrame:
    """Turn (length, position among its length) into sequence and offset."""
    spark = placed.sparkSession
    shared = spark.sparkContext.broadcast(table)     # bounded by the capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        keys = t["length"] << RANK_BITS | t["first"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("position").to_numpy()
            row = np.searchsorted(keys, length << RANK_BITS | rank, side="right") - 1
            nth = rank - t["first"][row]
            each = t["each"][row]
            kept = [c for c in batch.schema.names if c != "position"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept),
                 pa.array(t["sequence"][row] + nth // each),
                 pa.array(t["offset"][row] + nth % each * length)],
                [*kept, "sequence_id", "offset"])

    columns = [f"{f.name} {f.dataType.simpleString()}" for f in placed.schema
               if f.name != "position"]
    return placed.mapInArrow(run, ", ".join([*columns, "sequence_id long", "offset long"]))


def pack(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json",
         ranks: str | None = "byte_bpe_50k.tiktoken", capacity: int = CAPACITY,
         with_ids: bool = False) -> DataFrame:
    """Pack ``docs(doc_id, text)``: one row per piece with its sequence.

    Columns: doc_id, piece, start, length, ids_crc32, sequence_id, offset,
    and ids if asked for; the rows of a sequence, by offset, are the packed
    sequence.
    """
    ranks = tokens.tokenizer_path(ranks) if ranks else None
    cut_docs = pieces(docs.select("doc_id", "text"), tokens.tokenizer_path(tokenizer),
                      ranks, capacity, with_ids)
    stored = materialize(cut_docs, "pieces")
    counts = {r["length"]: r["n"] for r in
              stored.groupBy("length").agg(F.count("*").alias("n")).collect()}
    placed = numbered(stored, ["doc_id", "piece", "ids_crc32"], "length", size="_pieces")
    return assign(placed.drop("_pieces"), plan_table(plan(counts, capacity)))
