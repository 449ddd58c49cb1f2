"""Chat formatting by columnar byte assembly.

Every turn becomes marker, text, marker.  Control strings inside a text are
escaped by one backslash more than stands in front of them, which is undone
exactly by taking one away; a real marker never has a backslash in front,
because each one begins after a space or another marker.

The turns are dealt into ranges of (conversation, turn, role, text) and sorted
inside each, so a conversation that holds a third of all turns is formatted
by many tasks.  For each Arrow batch the
lengths of all segments (marker, role, text, ...) give cumulative offsets;
scatter indices then copy markers and contents with numpy into one
preallocated buffer that becomes the Arrow string column.  No Python string
is built per turn.

A conversation is one output row, or several parts if it is longer than
``PART_BYTES`` or goes on in the next range, cut between turns; so the memory
of a task is bounded however long a conversation is.  Part numbers ascend (by
range, then by place in it) but have gaps; the parts in order are its text.

Reading back parses all parts on their own.  Only the running digests of a
conversation have to follow its parts one after the other.

Defined results: a null text is empty; a null role is the empty role; a
null conv_id is a conversation of its own; turns are ordered by turn (null
first), then role, then text, and repeated turns are kept; an empty text
still gets its markers; other columns are not carried.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import shuffle_partitions

PART_BYTES = 8 << 20

# The template (fixed values).  Roles not listed are written out.
ROLES = ("system", "user", "assistant")
OPEN = ("<s>[SYS] ", "<s>[INST] ", "<s>[ANS] ", "<s>[ROLE] ")
BETWEEN = ("", "", "", " [TEXT] ")
CLOSE = (" [/SYS]", " [/INST]", " </s>", " [/TEXT]")
OTHER = len(ROLES)
LOSS_ROLE = ROLES.index("assistant")
CONTROL = r"(?:<s>|</s>|\[SYS\]|\[/SYS\]|\[INST\]|\[/INST\]|\[ANS\]|\[ROLE\]|\[TEXT\]|\[/TEXT\])"

_ESCAPED = re.compile(r"\\(\\*" + CONTROL + ")")
_TURN = re.compile(r"(?<!\\)<s>")


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _escape(column: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(column), F.lit("")),
                            r"\\*" + CONTROL, r"\\$0")


# -- assembly -------------------------------------------------------------

def _string_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, lengths) of an Arrow string column without nulls."""
    n = len(column)
    offsets = np.frombuffer(column.buffers()[1], dtype="int32")[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    body = np.frombuffer(data, dtype="uint8") if data is not None else np.zeros(0, "uint8")
    return body, offsets[:-1].astype("int64"), np.diff(offsets).astype("int64")


def _table(strings: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [s.encode() for s in strings]
    lengths = np.array([len(r) for r in raw], dtype="int64")
    return (np.frombuffer(b"".join(raw), dtype="uint8"),
            np.cumsum(lengths) - lengths, lengths)


def _scatter(out: np.ndarray, at: np.ndarray, body: np.ndarray,
             start: np.ndarray, length: np.ndarray) -> None:
    """Copy body[start : start + length] to out[at : ...] for every row."""
    step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    out[np.repeat(at, length) + step] = body[np.repeat(start, length) + step]


def assemble(kind: np.ndarray, role: pa.Array, text: pa.Array
             ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buffer, turn starts with the end, text starts, text ends) in bytes."""
    role_body, role_start, role_length = _string_view(role)
    text_body, text_start, text_length = _string_view(text)
    segments = []
    for strings in (OPEN, None, BETWEEN, "text", CLOSE):
        if strings is None:
            segments.append((role_body, role_start, np.where(kind == OTHER, role_length, 0)))
        elif strings == "text":
            segments.append((text_body, text_start, text_length))
        else:
            body, starts, lengths = _table(strings)
            segments.append((body, starts[kind], lengths[kind]))
    lengths = np.stack([s[2] for s in segments], axis=1)
    ends = np.cumsum(lengths.ravel()).reshape(lengths.shape)
    begins = ends - lengths
    out = np.empty(int(ends[-1, -1]) if len(kind) else 0, dtype="uint8")
    for k, (body, start, length) in enumerate(segments):
        _scatter(out, begins[:, k], body, start, length)
    turns = np.concatenate((begins[:, 0], ends[-1:, -1]))
    return out, turns, begins[:, 3], ends[:, 3]


def _lists(values: np.ndarray, owner: np.ndarray, n: int) -> pa.ListArray:
    ends = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=n)))).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


_RANGE_SHIFT = 32           # of a part number: range above, part in the range below
FORMATTED = ("conv_id long, part long, formatted string, turns int, "
             "loss_start array<long>, loss_end array<long>")

def _new_conversation(conv: pa.Array) -> np.ndarray:
    """True where a row's conversation differs from the row before."""
    value = conv.fill_null(0).to_numpy(zero_copy_only=False)
    null = conv.is_null().to_numpy(zero_copy_only=False)
    first = np.ones(len(value), dtype=bool)
    first[1:] = (value[1:] != value[:-1]) | (null[1:] != null[:-1])
    return first


def _emit(turns: pa.Table, part: int) -> pa.RecordBatch:
    """The formatted rows of whole runs; ``part`` numbers the first run."""
    batch = turns.combine_chunks().to_batches()[0]
    first = _new_conversation(batch.column("conv_id"))
    run = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    kind = batch.column("kind").to_numpy()
    out, at, text_from, text_to = assemble(kind, batch.column("role"), batch.column("text"))
    begin = at[starts]
    offsets = np.concatenate((begin, at[-1:])).astype("int32")
    formatted = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(out))
    loss = np.flatnonzero(kind == LOSS_ROLE)
    parts = np.full(len(starts), part >> _RANGE_SHIFT << _RANGE_SHIFT)
    parts[0] = part
    return pa.RecordBatch.from_arrays([
        batch.column("conv_id").take(pa.array(starts)), pa.array(parts), formatted,
        pa.array(np.bincount(run).astype("int32")),
        _lists(text_from[loss] - begin[run[loss]], run[loss], len(starts)),
        _lists(text_to[loss] - begin[run[loss]], run[loss], len(starts)),
    ], ["conv_id", "part", "formatted", "turns", "loss_start", "loss_end"])


def _format(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    base = (task.partitionId() if task else 0) << _RANGE_SHIFT
    held: pa.Table | None = None        # turns of the conversation still open
    part, cut_id = base, None           # its next part; its id if none are held
    for batch in batches:
        if not batch.num_rows:
            continue
        turns = pa.Table.from_batches([batch])
        if held is not None:
            turns = pa.concat_tables([held, turns])
        elif part > base and turns.column("conv_id")[0].as_py() != cut_id:
            part = base
        ids = turns.column("conv_id").combine_chunks()
        last = int(np.flatnonzero(_new_conversation(ids))[-1])
        if last:
            yield _emit(turns.slice(0, last), part)
            part = base
        held = turns.slice(last)
        if held.nbytes > PART_BYTES:
            yield _emit(held, part)
            part, cut_id, held = part + 1, ids[-1].as_py(), None
    if held is not None:
        yield _emit(held, part)


def format_conversations(turns: DataFrame) -> DataFrame:
    """(conv_id, part, formatted, turns, loss_start, loss_end) of
    ``turns(conv_id, turn, role, text)``; the loss spans are byte ranges of
    ``formatted`` that hold the assistant's (escaped) texts.
    """
    role = F.coalesce("role", F.lit(""))
    kind = F.lit(OTHER)
    for k, name in enumerate(ROLES):
        kind = F.when(role == name, F.lit(k)).otherwise(kind)
    ordered = (turns.select(F.col("conv_id").cast("long"), "turn", "role", "text")
               .withColumn("salt", F.rand(3))
               .repartitionByRange(shuffle_partitions(turns.sparkSession),
                                   "conv_id", "turn", "role", "text", "salt")
               .sortWithinPartitions("conv_id", "turn", "role", "text"))
    return ordered.select("conv_id", kind.alias("kind"), _escape("role").alias("role"),
                          _escape("text").alias("text")).mapInArrow(_format, FORMATTED)


# -- reading back ---------------------------------------------------------

def parse(formatted: str) -> list[tuple[str, str]]:
    """[(role, text)] of one formatted part."""
    out = []
    for turn in _TURN.split(formatted)[1:]:
        for name, start, end in zip((*ROLES, None), OPEN, CLOSE):
            begin = start.removeprefix("<s>")
            if turn.startswith(begin) and turn.endswith(end):
                body = turn[len(begin):len(turn) - len(end)]
                if name is None:
                    name, body = body.split(BETWEEN[OTHER], 1)
                out.append((unescape(name), unescape(body)))
                break
        else:
            raise ValueError(f"not a turn: {turn[:80]!r}")
    return out


_PIECES = ("conv_id long, part long, n_turns long, turns binary, loss binary, loss_chars long, "
           "formatted_chars long")


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each formatted part adds to its conversation's digests."""
    names = [c.split()[0] for c in _PIECES.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64()]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        rows, size = [], 0
        for k in range(batch.num_rows):
            conv_id, part, formatted, a, b = (batch.column(c)[k].as_py() for c in (
                "conv_id", "part", "formatted", "loss_start", "loss_end"))
            found = parse(formatted)
            turns = "".join(f"{role}\n{text}\n" for role, text in found).encode()
            raw = formatted.encode()
            loss = "".join(unescape(raw[i:j].decode()) for i, j in zip(a, b))
            rows.append((conv_id, part, len(found), turns, loss.encode(), len(loss), len(formatted)))
            size += len(raw)
            if size > PART_BYTES:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)


class _Digest:
    """Running digests of one conversation."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def add(self, piece: dict) -> None:
        self.turns.update(piece["turns"])
        self.loss.update(piece["loss"])
        self.n_turns += piece["n_turns"]
        self.loss_chars += piece["loss_chars"]
        self.formatted_chars += piece["formatted_chars"]

    def row(self) -> tuple:
        return (self.conv_id, self.n_turns, self.turns.hexdigest(), self.loss_chars,
                self.loss.hexdigest(), self.formatted_chars)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()),
                        ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                        ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def out(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) if rows else [[]] * len(schema)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    now: _Digest | None = None
    for batch in batches:
        done = []
        for k in range(0, batch.num_rows, 100):
            for piece in batch.slice(k, 100).to_pylist():
                if now is None or piece["conv_id"] != now.conv_id:
                    if now is not None:
                        done.append(now.row())
                    now = _Digest(piece["conv_id"])
                now.add(piece)
        yield out(done)
    if now is not None:
        yield out([now.row()])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of every conversation, parsed from the formatted text."""
    pieces = formatted.mapInArrow(_pieces, _PIECES)
    return pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(
        _digests, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, "
                  "loss_sha256 string, formatted_chars long")
