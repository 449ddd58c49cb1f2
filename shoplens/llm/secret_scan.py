"""Secret scans: fixed patterns, and Markov models of random strings.

Base spans are the matches of three patterns, per kind leftmost and without
overlaps; those whose value is too short are dropped after the matching, so
the text they cover is used up.  The method adds spans of kind ``random``:
every run of at least ``MIN_RUN`` characters of ``[A-Za-z0-9+/_=-]`` is judged
by two Markov chains over characters, one of random strings and one of
ordinary identifiers.  The log-likelihood ratio is a sum of one weight per
pair of neighbouring characters (with both ends); a run is a span if it
reaches ``MIN_RATIO``.  Spans of different kinds may overlap; base spans stay.

``train`` counts the character pairs of labelled samples; ``labelled_samples``
makes some by rule (``SAMPLES`` of each label): pieces of digests in usual
encodings, and names, paths, dates, numbers and rulers of ordinary words.
Only pair weights, some 4,600 numbers, reach the driver.

Everything is built from SQL functions and a text never leaves its row.  A
text without a match of a pattern costs one search; where there are matches,
the gaps between them (``split``) and the matches give the places by a running
sum in blocks, whose cost does not grow with the square of their number.

Defined results: a null or empty text has no spans, and the digest of an empty
string; places are code points, the end exclusive; repeated rows get equal
results; a null doc_id and other columns pass through, but a column named like
the output is replaced; an empty table has no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.llm.quality_rules import _let

# Kind, pattern, group of the value, its smallest length.
BASE = (
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
               r"""([A-Za-z0-9+/_.=-]+)""", 1, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
)
# A run that is too short uses up nothing that a longer match needs, so these
# patterns may ask for the length themselves.
_SEARCH = {"access": "AKIA[A-Z0-9]{16,}", "hex": "[0-9a-f]{24,}"}
RANDOM = "random"

MIN_RUN = 20
MIN_RATIO = 8000            # of the likelihoods, in thousandths of nats
SAMPLES = 4000              # of each label

_CHARS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
_EDGE = len(_CHARS)
_STATES = _EDGE + 1
_RUN = f"[A-Za-z0-9+/_=-]{{{MIN_RUN},}}"
_BLOCK = 100                # matches whose places are summed at once

_RULERS = "-=_/+x0aA"       # characters that are often repeated

# Parts of ordinary identifiers.
_WORDS = ("account action active address admin after agent alert amount application archive array "
          "article author average balance batch before binary block border branch bridge browser "
          "buffer build button cache calendar callback cancel category center channel character "
          "check city class client cluster code collection color column command comment common "
          "company component config connection container content context controller cookie count "
          "country create currency current customer data database date default delete delivery "
          "description design detail device dialog directory discount display document domain "
          "download driver duration editor element email employee enable encoding engine entity "
          "entry environment error event example export factory feature field file filter folder "
          "footer format frame function gateway general global graph group handler header height "
          "history home host image import index info input insert instance integer interface "
          "internal invoice item job journal keyboard label language layout length level library "
          "license limit line link list local location logger manager market master memory menu "
          "message method metric mobile model module monitor name network node notification number "
          "object office option order output package page panel parameter parser partner path "
          "pattern payment people period person phone picture platform player point policy position "
          "price print process product profile program project property protocol provider public "
          "quality query queue random range reader record region registry release remote report "
          "request resource response result return review role router running sample scale schedule "
          "schema school screen script search section security segment select sender sequence "
          "series server service session setting shadow shipping signal simple single size snapshot "
          "source special standard start state static status storage store stream string structure "
          "student style subject support switch symbol system table target task template test text "
          "thread time title today toolbar total tracking traffic transaction transfer type unit "
          "update upload user utility validation value variable vector vendor version video view "
          "visible volume warning weather website week weight widget width window worker world "
          "writer year zone").split()


def _ints(values: list[int]) -> Column:
    """A constant array; the optimizer folds it into one literal."""
    return F.expr(f"cast(split('{','.join(map(str, values))}', ',') as array<int>)")


def _states(text: Column) -> Column:
    """The states (one per character) of a text of ``_CHARS``."""
    table = [_EDGE] * 128
    for k, c in enumerate(_CHARS):
        table[ord(c)] = k
    characters = F.filter(F.split(text, ""), lambda c: c != "")
    return F.transform(characters, lambda c: F.coalesce(
        F.get(_ints(table), F.ascii(c)), F.lit(_EDGE)))


def _digest(salt: str, *key: Column) -> Column:
    return F.sha2(F.concat(F.lit(salt), *[c.cast("string") for c in key]), 256)


def _spread(n: int, salt: str, *key: Column) -> Column:
    """A number below ``n`` that depends on the key."""
    return (F.conv(F.substring(_digest(salt, *key), 1, 8), 16, 10).cast("long") % n).cast("int")


def _one_of(choice: Column, values: list[Column]) -> Column:
    """The value of the given number; only that one is computed."""
    def chosen(c: Column) -> Column:
        out = values[-1]
        for k, value in reversed(list(enumerate(values[:-1]))):
            out = F.when(c == k, value).otherwise(out)
        return out
    return _let(choice, chosen)


def labelled_samples(spark: SparkSession, n: int = SAMPLES, first: int = 0) -> DataFrame:
    """(text, random) of 2 n strings; other numbers from ``first`` on give
    other strings."""
    k = F.col("id")
    size = _spread(45, "size", k) + MIN_RUN

    def cut(text: Column, length: int | Column = size) -> Column:
        return F.substr(text, F.lit(1), F.lit(length) if isinstance(length, int) else length)

    coded = F.translate(F.concat(*[F.base64(F.unhex(_digest(s, k))) for s in ("left", "right")]), "=", "")
    plain = F.translate(coded, "+/", "")
    random = _one_of(_spread(9, "random", k), [
        cut(_digest("hex", k)), cut(F.upper(_digest("hex", k))), cut(coded),
        cut(F.translate(coded, "+/", "-_")), cut(plain), cut(plain), cut(F.upper(plain)),
        cut(F.lower(plain)), F.concat(cut(coded, 43), F.lit("="))])

    digits = F.translate(_digest("digits", k), "abcdef", "012345")

    def named(w: Column) -> Column:
        return _one_of(_spread(11, "ordinary", k), [
            F.array_join(w, "_"), F.array_join(w, "-"), F.array_join(w, "/"),
            F.array_join(F.transform(w, F.initcap), ""), F.upper(F.array_join(w, "_")),
            F.array_join(w, ""), F.concat(F.array_join(w, "_"), F.lit("_"), cut(digits, 4)),
            F.concat(F.lit("/"), F.array_join(w, "/"), F.lit("-"), cut(digits, 2)),
            F.date_format(F.timestamp_seconds(_spread(1 << 30, "time", k)), "yyyy-MM-dd-HH-mm-ss"),
            cut(digits), F.repeat(F.substr(F.lit(_RULERS), _spread(len(_RULERS), "ruler", k) + 1,
                                           F.lit(1)), size)])

    ordinary = _let(F.transform(
        F.sequence(F.lit(1), _spread(4, "words", k) + 3),
        lambda i: F.get(F.split(F.lit(" ".join(_WORDS)), " "),
                        _spread(len(_WORDS), "word", k, F.lit("/"), i))), named)
    ids = spark.range(first, first + n)
    return (ids.select(random.alias("text"), F.lit(True).alias("random"))
            .unionAll(ids.select(ordinary.alias("text"), F.lit(False).alias("random"))))


def train(samples: DataFrame) -> list[int]:
    """Pair weights (thousandths of nats) from ``samples(text, random)``: the
    log ratio of the two chains' transitions, with one count added to each."""
    def pairs(s: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(s)), lambda i: F.coalesce(
            F.get(s, i - 1), F.lit(_EDGE)) * _STATES + F.coalesce(F.get(s, i), F.lit(_EDGE)))

    found = (samples.where("text != ''").select("random", F.explode(_let(_states(F.col("text")), pairs)).alias("pair"))
             .groupBy("random", "pair").agg(F.count("*").alias("n")))
    counts = {True: [1] * _STATES ** 2, False: [1] * _STATES ** 2}
    for row in found.collect():                 # a row per label and pair
        counts[row["random"]][row["pair"]] += row["n"]
    share = {label: [math.log(n / sum(c[k - k % _STATES:k - k % _STATES + _STATES]))
                     for k, n in enumerate(c)] for label, c in counts.items()}
    return [round(1000 * (a - b)) for a, b in zip(share[True], share[False])]


def ratio(text: Column, model: list[int]) -> Column:
    """The log-likelihood ratio of a text, random against ordinary."""
    table = _ints(model)

    def step(acc: Column, s: Column) -> Column:
        return F.struct(s.alias("last"), (acc.total + F.get(table, acc.last * _STATES + s)).alias("total"))

    return F.aggregate(
        _states(text), F.struct(F.lit(_EDGE).alias("last"), F.lit(0).alias("total")), step,
        lambda acc: acc.total + F.get(table, acc.last * _STATES + F.lit(_EDGE)))


def _placed(items: Column, kind: int) -> Column:
    """(start, kind, end) of ``items(gap, size, ok)`` that lie one after the
    other, a gap before each."""
    def run(block: Column, start: Column) -> Column:
        return F.aggregate(
            block, F.struct(start.alias("at"), F.array().cast(
                "array<struct<start:int,kind:int,end:int,ok:boolean>>").alias("out")),
            lambda acc, x: F.struct(
                (acc.at + x.gap + x.size).alias("at"),
                F.array_append(acc.out, F.struct(
                    (acc.at + x.gap).alias("start"), F.lit(kind).alias("kind"),
                    (acc.at + x.gap + x.size).alias("end"), x.ok.alias("ok"))).alias("out")),
            lambda acc: acc.out)

    def starts(blocks: Column) -> Column:
        sums = F.transform(blocks, lambda b: F.aggregate(
            b, F.lit(0), lambda acc, x: acc + x.gap + x.size))
        return F.aggregate(
            sums, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("out")),
            lambda acc, x: F.struct((acc.at + x).alias("at"),
                                    F.array_append(acc.out, acc.at).alias("out")),
            lambda acc: acc.out)

    def of_blocks(blocks: Column) -> Column:
        return F.flatten(F.zip_with(blocks, starts(blocks), run))

    def of_items(x: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.size(x) - 1, F.lit(_BLOCK)),
                             lambda i: F.slice(x, i + 1, _BLOCK))
        return _let(blocks, of_blocks)

    return F.transform(F.filter(_let(items, of_items), lambda x: x.ok),
                       lambda x: F.struct(x.start.alias("start"), x.kind.alias("kind"), x.end.alias("end")))


def _spans(text: Column, pattern: str, kind: int, keep: Callable[[Column], Column]) -> Column:
    """The places of the matches that ``keep`` accepts, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    items = F.zip_with(found, F.split(text, pattern, -1), lambda m, gap: F.struct(
        F.length(gap).alias("gap"), F.length(m).alias("size"), keep(m).alias("ok")))
    # There is one more gap than there are matches.
    matched = F.filter(items, lambda x: x["size"].isNotNull())
    return F.when(text.rlike(pattern), _placed(matched, kind)).otherwise(
        F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def scan(docs: DataFrame, model: list[int], text: str = "text", out: str = "secrets") -> DataFrame:
    """``docs`` plus a struct: ``base`` and ``spans`` (all), arrays of (kind,
    start, end) by start and then kind, and ``n_<kind>`` for every kind."""
    names = F.array(*[F.lit(name) for name, *_ in BASE], F.lit(RANDOM))

    def named(spans: Column) -> Column:
        return F.transform(F.sort_array(spans), lambda x: F.struct(
            F.get(names, x.kind).alias("kind"), x.start.alias("start"), x.end.alias("end")))

    def of_text(t: Column) -> Column:
        base = []
        for k, (name, pattern, group, least) in enumerate(BASE):
            def keep(m: Column, pattern=pattern, group=group, least=least) -> Column:
                return F.length(F.regexp_extract(m, pattern, group) if group else m) >= least
            base.append(_spans(t, _SEARCH.get(name, pattern), k, keep))
        added = _spans(t, _RUN, len(BASE), lambda m: ratio(m, model) >= MIN_RATIO)
        return _let(F.array(*base, added), result)

    def result(found: Column) -> Column:
        base = F.flatten(F.slice(found, 1, len(BASE)))
        return F.struct(
            named(base).alias("base"), named(F.flatten(found)).alias("spans"),
            *[F.size(F.get(found, k)).cast("long").alias(f"n_{name}")
              for k, name in enumerate([*(name for name, *_ in BASE), RANDOM])])

    return docs.withColumn(out, _let(F.coalesce(F.col(text), F.lit("")), of_text))


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", x.kind, x.start.cast("string"), x.end.cast("string"))), ",")
