"""Quality rules: a threshold table compiled into one Spark projection.

Words are runs of characters other than space and U+0009..U+000D.  Each rule
of ``RULES`` bounds one measure of a whole text; ``kept`` is the conjunction
of the base rule and all bounds.  Everything is built from SQL functions: no
user function, no join, no exchange.  A value that is used several times is
bound once per row (``_let``), so a text is split once however many measures
read its words.

Defined results: a null text has no words, so it fails the base rule; empty
and blank texts likewise; repeated rows get equal verdicts; other columns
pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import unused

WHITE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

# Frequent function words of the four languages.
STOP_WORDS = {
    "en": "the of and to in a is that it for as was with be by on not he his are this at from",
    "fr": "de la le et les des un une du en que qui dans est pour pas sur au par avec ce il",
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als",
    "es": "de la que el en y a los se del las un por con no una su para es al lo como",
}

# Base rule of the contract.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# The threshold table: measure, smallest and largest value that is kept.
RULES: list[tuple[str, float | None, float | None]] = [
    ("mean_word_length", 2.0, 15.0),       # code points a word
    ("symbol_ratio", None, 0.1),           # symbols a word
    ("shout_ratio", None, 0.3),            # exclamation marks a word
    ("capital_ratio", None, 0.4),          # words without a lower-case letter
    ("stop_word_ratio", 0.02, 0.8),        # function words a word
    ("dup_line_ratio", None, 0.5),         # repeated lines a line
    ("repeat_ratio", None, 0.5),           # words in repeated 3-word windows
]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, evaluated once."""
    return F.transform(F.array(value), body).getItem(0)


def words_of(text: Column) -> Column:
    """The words of a non-null text, in order."""
    trimmed = F.btrim(text, F.lit(WHITE))
    parts = F.split(trimmed, "[\\x20\\x09-\\x0D]+")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(parts)


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text.

    Each window becomes one long: its hash in the high bits, its place in as
    many low bits as the text needs.  Sorting the longs puts equal windows
    side by side; a neighbour with the same high bits counts once its three
    words are equal.  The places found are then merged into covered words.
    """
    shift = lambda name, x, n: F.call_function(name, x, n)

    def with_bits(w: Column, bits: Column) -> Column:
        def place(x: Column) -> Column:
            return x.bitwiseAND(shift("shiftleft", F.lit(1).cast("long"), bits) - 1).cast("int")

        def high(x: Column, y: Column) -> Column:
            return shift("shiftright", x.bitwiseXOR(y), bits) == 0

        def same(x: Column, y: Column) -> Column:
            i, j = place(x), place(y)
            equal = high(x, y)
            for k in range(3):
                equal = equal & (F.get(w, i + k) == F.get(w, j + k))
            return F.coalesce(equal, F.lit(False))

        def near(s: Column) -> Column:
            return F.filter(s, lambda x, k: high(x, F.get(s, k - 1)) | high(x, F.get(s, k + 1)))

        def twins(s: Column) -> Column:
            return F.filter(s, lambda x, k: same(x, F.get(s, k - 1)) | same(x, F.get(s, k + 1))
                            | same(x, F.get(s, k - 2)) | same(x, F.get(s, k + 2)))

        def covered(p: Column) -> Column:
            steps = F.aggregate(
                p, F.struct(F.lit(0).cast("long").alias("n"), F.lit(-3).alias("last")),
                lambda acc, i: F.struct(
                    (acc.n + F.least(F.lit(3), i - acc.last)).alias("n"), i.alias("last")))
            return steps.n

        packed = F.transform(
            F.sequence(F.lit(0), F.size(w) - 3),
            lambda i: shift("shiftleft", F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)),
                            bits).bitwiseOR(i.cast("long")))
        return _let(F.sort_array(packed), lambda s: _let(
            near(s), lambda c: covered(F.sort_array(F.transform(twins(c), place)))))

    def of_words(w: Column) -> Column:
        return _let(F.length(F.bin(F.size(w).cast("long"))), lambda bits: with_bits(w, bits))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(of_words(words))


def _count(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("long")


def measures(text: Column) -> Column:
    """One struct with the contract's base counts and the rules' counts."""
    stop = sorted({w for line in STOP_WORDS.values() for w in line.split()})

    def of_text(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(WHITE)) != "")

        def of_words(w: Column) -> Column:
            return F.struct(
                F.size(w).cast("long").alias("n_words"),
                (F.length(t) - _count(t, WHITE)).cast("long").alias("word_chars"),
                _count(t, SYMBOLS).alias("n_symbols"),
                _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
                .cast("long").alias("n_dup_lines"),
                repeated_words(w).alias("n_repeat_words"),
                F.size(lines).cast("long").alias("n_lines"),
                _count(t, "!").alias("n_shouts"),
                F.size(F.filter(w, lambda x: (F.upper(x) == x) & (F.lower(x) != x)))
                .cast("long").alias("n_capitals"),
                F.size(F.filter(w, lambda x: F.lower(F.btrim(x, F.lit(".,;:!?\"'()"))).isin(stop)))
                .cast("long").alias("n_stop_words"))
        return _let(words_of(t), of_words)

    return _let(F.coalesce(text, F.lit("")), of_text)


def _ratios(m: Column) -> dict[str, Column]:
    def per(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))
    return {
        "mean_word_length": per(m.word_chars, m.n_words),
        "symbol_ratio": per(m.n_symbols, m.n_words),
        "shout_ratio": per(m.n_shouts, m.n_words),
        "capital_ratio": per(m.n_capitals, m.n_words),
        "stop_word_ratio": per(m.n_stop_words, m.n_words),
        "dup_line_ratio": per(m.n_dup_lines, m.n_lines),
        "repeat_ratio": per(m.n_repeat_words, m.n_words),
    }


def apply_rules(df: DataFrame, text: str = "text",
                rules: list[tuple[str, float | None, float | None]] = RULES,
                measure: str = "quality") -> DataFrame:
    """``df`` plus a struct column: base counts, base_failed and kept."""
    def verdict(m: Column) -> Column:
        failed = ((m.n_words < MIN_WORDS)
                  | (m.n_repeat_words * 100 > m.n_words * MAX_REPEAT_PERCENT))
        ratios = _ratios(m)
        kept = ~failed
        for name, low, high in rules:
            if low is not None:
                kept = kept & (ratios[name] >= low)
            if high is not None:
                kept = kept & (ratios[name] <= high)
        return F.struct(m.n_words.alias("n_words"), m.word_chars.alias("word_chars"),
                        m.n_symbols.alias("n_symbols"), m.n_dup_lines.alias("n_dup_lines"),
                        m.n_repeat_words.alias("n_repeat_words"),
                        failed.alias("base_failed"), kept.alias("kept"))
    return df.withColumn(measure, _let(measures(F.col(text)), verdict))


def keep_good(df: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``df`` that the rules keep, with the columns of ``df``."""
    name = unused(df, "_quality")
    return apply_rules(df, text, measure=name).where(F.col(name).kept).drop(name)
