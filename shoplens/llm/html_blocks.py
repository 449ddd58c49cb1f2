"""Main text of web pages with a recurrent block labeller.

A page becomes the sequence of its leaf text blocks.  Each block has a
tag-path vector (hashed tags, classes and ids of its ancestors) and a
hashed-word vector with a few counts.  A bidirectional LSTM, in numpy, reads
the sequence of a page in both directions and labels every block main text
or not, so a block is judged with the whole document as its context.  The
blocks labelled main, in page order, joined by two line feeds, are the text.

The weights were trained by ``html_training`` on generated pages and lie
beside this module; no page of a corpus is used for training.

Blocks: block-level tags end a block, inline tags do not; ``br`` counts as
white space.  Character references are decoded, white space inside a block
becomes one space, and blank blocks vanish.  Scripts, styles, templates and
other unrendered elements never give text.  Unclosed and stray tags are
repaired the way browsers do for paragraphs, list items and table cells;
a tag cut off by the end of the page is dropped.  Quotes belong to attributes
only right after ``=``; elsewhere they are ordinary characters.  A path is a
hashed set, kept per open tag, so every ancestor counts at any depth.

Defined results: null or empty html gives an empty text; so does a page
without a main block; repeated rows repeat their text; extra columns are
ignored.
"""

from __future__ import annotations

import html
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache, lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PATH_SIZE = 192             # hashed path dimensions
WORD_SIZE = 48              # hashed word dimensions
COUNTS = 8
HIDDEN = 24
BATCH_CHARS = 2 << 20
WEIGHTS = os.path.join(os.path.dirname(__file__), "html_blocks.npz")

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark "
                   "nobr q rp rt ruby s samp small span strike strong sub sup time tt u var wbr "
                   "img picture source track area map".split())
VOID = frozenset("area base br col embed frame hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
HIDDEN_TAGS = frozenset("script style template title iframe noframes noembed svg canvas object "
                        "audio video head select datalist math".split())
# An opening tag of the key closes an open tag of the value, up to a scope.
CLOSES = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
          "td": ("td", "th"), "th": ("td", "th"), "option": ("option",),
          "thead": ("tr", "td", "th"), "tbody": ("thead", "tbody", "tr", "td", "th"),
          "body": ("head",)}
SCOPE = frozenset("ul ol dl table body html article section main nav aside header footer form "
                  "div".split())

# An attribute as HTML reads it: quotes mean something only right after ``=``;
# a quoted value without an end is no value, so its tag ends at the next ``>``.
_KEY = r"(?:=[^\s/>=]*+|[^\s/>=]++)"
_VALUE = r"""\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+|(?=>))"""
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|" + _KEY + "(?:" + _VALUE.replace("(", "(?:", 1) + r")?+)*+)(>|\Z)"
    r"|<[!?][^>]*>?"
    r"|[^<]+|<", re.S)
_ATTRIBUTE = re.compile(f"({_KEY})(?:{_VALUE})?+", re.S)
_NAMING = frozenset(("class", "id", "role"))
_NAME = re.compile(r"[a-z]+|[A-Z][a-z]*")


class Block(NamedTuple):
    path: int                   # bits of the path vector: all ancestors' tags and names
    text: str
    link_chars: int


def _label(tag: str, attributes: str) -> str:
    """A tag with the words of its class, id and role, such as ``div ad top``."""
    names = []
    if "=" in attributes:
        for key, value in _ATTRIBUTE.findall(attributes):
            if value and key.lower() in _NAMING:
                names += [n.lower() for n in _NAME.findall(value.strip("\"'"))]
    return " ".join([tag, *dict.fromkeys(names)])


def _bucket(name: str, size: int) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % size


@lru_cache(100_000)
def _label_bits(label: str) -> int:
    """The path buckets of one label."""
    tag, *names = label.split(" ")
    features = [] if tag in ("html", "body") else ["tag " + tag, "2tag " + tag]
    features += [kind + n for n in names for kind in ("name ", "2name ")]
    out = 0
    for f in features:
        out |= 1 << _bucket(f, PATH_SIZE)
    return out


@lru_cache(10_000)
def _leaf_bit(tag: str) -> int:
    return 1 << _bucket("leaf " + tag, PATH_SIZE)


def blocks(page: str) -> list[Block]:
    """The leaf text blocks of a page in order."""
    out: list[Block] = []
    stack: list[str] = []           # open block tags
    paths: list[int] = [0]          # path bits down to each of them
    text: list[str] = []
    links: list[str] = []
    in_link = hidden = 0            # hidden: how deep inside unrendered tags

    def flush() -> None:
        if text:
            body = " ".join("".join(text).split())
            if body:
                linked = " ".join("".join(links).split())
                out.append(Block(paths[-1] | (_leaf_bit(stack[-1]) if stack else 0), body, len(linked)))
            text.clear()
            links.clear()

    def pop_to(depth: int) -> None:
        nonlocal hidden
        for tag in stack[depth:]:
            hidden -= tag in HIDDEN_TAGS
        del stack[depth:], paths[depth + 1:]

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.match(page, at)
        at = m.end()
        tag = m.group(2)
        if tag is None:
            if page[m.start()] != "<" or m.end() - m.start() == 1:
                if not hidden:
                    piece = html.unescape(m.group())
                    text.append(piece)
                    if in_link:
                        links.append(piece)
            continue
        if not m.group(4):                              # cut off by the end of the page
            continue
        tag = tag.lower()
        if m.group(1):                                  # closing tag
            if tag == "a":
                in_link = 0
            elif tag == "br":
                text.append(" ")
            if tag in INLINE or tag in VOID:
                continue
            flush()
            if tag in stack:
                depth = len(stack) - 1 - stack[::-1].index(tag)
                if tag != "p" or not any(t in SCOPE for t in stack[depth + 1:]):
                    pop_to(depth)
            continue
        if tag == "a":
            in_link = 1
        if tag == "br":
            text.append(" ")
            continue
        if tag in RAW:
            end = re.compile("</" + re.escape(tag) + r"[\s/>]", re.I).search(page, at)
            if tag == "textarea" and not hidden:
                flush()
                body = page[at:end.start() if end else size]
                stack.append(tag)
                paths.append(paths[-1] | _label_bits(_label(tag, m.group(3))))
                text.append(html.unescape(body))
                flush()
                pop_to(len(stack) - 1)
            at = page.find(">", end.start()) + 1 if end else size
            at = at or size
            continue
        if tag in INLINE:
            continue
        flush()
        if tag in VOID:
            continue
        if stack and stack[-1] == "p":                  # a block ends a paragraph
            pop_to(len(stack) - 1)
        closed, depth = CLOSES.get(tag, ()), len(stack)
        while closed and depth and stack[depth - 1] not in SCOPE:
            depth -= 1
            if stack[depth] in closed:
                pop_to(depth)
        stack.append(tag)
        paths.append(paths[-1] | _label_bits(_label(tag, m.group(3))))
        hidden += tag in HIDDEN_TAGS
    flush()
    return out


# -- vectors --------------------------------------------------------------

def path_vector(path: int) -> np.ndarray:
    """The path bits as numbers."""
    raw = np.frombuffer(path.to_bytes(PATH_SIZE // 8, "little"), "uint8")
    return np.unpackbits(raw, bitorder="little").astype("float32")


class _WordBuckets(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > 200_000:
            self.clear()
        value = self[word] = _bucket("word " + word, WORD_SIZE)
        return value


_WORDS = _WordBuckets()


def word_vector(block: Block, place: float) -> np.ndarray:
    """Hashed words (log counts a block) and the counts of a block."""
    words = block.text.lower().split()
    n = len(words)
    at = np.fromiter(map(_WORDS.__getitem__, words), dtype="int64", count=n)
    out = np.empty(WORD_SIZE + COUNTS, dtype="float32")
    out[:WORD_SIZE] = np.minimum(np.bincount(at, minlength=WORD_SIZE) * (4.0 / max(n, 4)), 1.0)
    chars = len(block.text)
    out[WORD_SIZE:] = (np.log1p(n) / 5, np.log1p(chars) / 7, n < 4, n > 15,
                       block.link_chars / chars, block.text.endswith((".", "!", "?")),
                       min(1.0, 8 * (block.text.count(".") + block.text.count(",")) / n), place)
    return out


# -- the network ----------------------------------------------------------

class Weights(NamedTuple):
    path: np.ndarray        # (2, PATH_SIZE, 4 HIDDEN): both directions
    word: np.ndarray        # (2, WORD_SIZE + COUNTS, 4 HIDDEN)
    state: np.ndarray       # (2, HIDDEN, 4 HIDDEN)
    bias: np.ndarray        # (2, 4 HIDDEN)
    out: np.ndarray         # (2 HIDDEN + 1,)


@cache
def weights(path: str = WEIGHTS) -> Weights:
    with np.load(path) as f:
        return Weights(*(f[n].astype("float32") for n in Weights._fields))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def run_lstm(gates: np.ndarray, state: np.ndarray, lengths: np.ndarray, reverse: bool) -> np.ndarray:
    """Hidden states of one direction for sequences laid end to end.

    ``gates`` holds the input part of the gates (input, forget, output,
    candidate) of every block; sequences are stepped together.
    """
    hidden = np.zeros((len(gates), HIDDEN), dtype=gates.dtype)
    ends = np.cumsum(lengths)
    order = np.argsort(-lengths, kind="stable")
    size = lengths[order]
    begin = (ends - 1)[order] if reverse else (ends - lengths)[order]
    sign = -1 if reverse else 1
    h = np.zeros((len(lengths), HIDDEN), dtype=gates.dtype)
    c = np.zeros_like(h)
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), side="left")
    for t in range(longest):
        k = alive[t]
        at = begin[:k] + sign * t
        z = gates[at] + h[:k] @ state
        gate = _sigmoid(z[:, :3 * HIDDEN])
        c = gate[:, HIDDEN:2 * HIDDEN] * c[:k] + gate[:, :HIDDEN] * np.tanh(z[:, 3 * HIDDEN:])
        h = gate[:, 2 * HIDDEN:] * np.tanh(c)
        hidden[at] = h
    return hidden


class Labeller:
    """Labels the blocks of pages; keeps projected paths per worker."""

    def __init__(self, w: Weights):
        self.w = w
        self.paths: dict[int, np.ndarray] = {}

    def _path(self, path: int) -> np.ndarray:
        found = self.paths.get(path)
        if found is None:
            if len(self.paths) > 20_000:
                self.paths.clear()
            found = self.paths[path] = path_vector(path) @ self.w.path + self.w.bias
        return found

    def scores(self, pages: list[list[Block]]) -> np.ndarray:
        """Probability of main text for every block of all pages."""
        lengths = np.array([len(p) for p in pages if p], dtype="int64")
        if not len(lengths):
            return np.zeros(0)
        flat = [b for p in pages for b in p]
        place = [k / len(p) for p in pages for k in range(len(p))]
        path = np.stack([self._path(b.path) for b in flat], axis=1)
        word = np.stack([word_vector(b, x) for b, x in zip(flat, place)])
        sides = [run_lstm(path[d] + word @ self.w.word[d], self.w.state[d], lengths, bool(d))
                 for d in range(2)]
        return _sigmoid(np.hstack(sides) @ self.w.out[:-1] + self.w.out[-1])


@cache
def labeller() -> Labeller:
    return Labeller(weights())


def main_texts(pages: list[str | None]) -> list[str]:
    """The main text of every page."""
    cut = [blocks(p or "") for p in pages]
    main = labeller().scores(cut) >= 0.5
    out, k = [], 0
    for page in cut:
        out.append("\n\n".join(b.text for b, m in zip(page, main[k:k + len(page)]) if m))
        k += len(page)
    return out


def extract(pages: DataFrame, html_column: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of ``pages``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("html").to_pylist()
            texts: list[str] = []
            part: list[str | None] = []
            size = 0
            for k, page in enumerate(raw):
                part.append(page)
                size += len(page or "")
                if size > BATCH_CHARS or k + 1 == len(raw):
                    texts += main_texts(part)
                    part, size = [], 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"])
    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", pages[html_column].alias("html")).mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
