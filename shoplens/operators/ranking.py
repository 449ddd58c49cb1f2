"""Exact order statistics of a large table without sorting it.

``NTILE`` and ``PERCENTILE_CONT`` need the rows at a few positions of a
global order, not the order itself.  ``rows_at`` finds them in passes; each
pass scans the table once, whatever the number of positions:

* every order (a scope: a column, or the tie-break among the rows of one
  value) has a few split points, which cut it into pieces: the points
  themselves and the gaps between them.  A row falls into one piece per
  scope, and the rows are counted per (scope, piece) (a partial aggregate,
  so a hot value costs one row per task);
* the pieces where positions are expected also get a KLL sketch of their
  values, whose quantiles are the split points of the next pass.

The counts are exact, so the sketches only decide how fast the pieces shrink,
never the result.  A piece of at most ``FETCH`` rows is collected and ends the
search; so does a point, or, where ties have to be broken, it becomes a scope
of the tie-break column.  The plan is the same at every size; no pass sorts or
gathers rows.  With the cut rows known, classifying all rows is a map-side
lexicographic comparison.

A NULL tie-break orders before all others.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoplens.session import reliable

BINS = 256          # quantiles that a sketch is asked for
SKETCH = 800        # size of a sketch: its ranks err by about 0.4 %
FETCH = 20_000      # rows of a piece that may come to the driver

Where = tuple[str, str] | None          # (column, value as exact text) the rows share


@dataclass
class _Scope:
    """One order: a column, among all rows or those that share a value."""
    column: str
    where: Where
    tie: str | None
    points: list[str] = field(default_factory=list)
    wanted: set[int] = field(default_factory=set)       # pieces to sketch


@dataclass
class _Search:
    """The row at a 0-based position of a scope; ``piece``: what is known."""
    columns: tuple[str, ...]
    position: int
    where: Where = None
    found: tuple = ()
    fetch: tuple[str, str, int] | None = None           # (low, high, rows below)

    @property
    def column(self) -> str:
        return self.columns[0 if self.where is None else 1]

    @property
    def scope(self) -> tuple[str, Where]:
        return self.column, self.where


def _literal(df: DataFrame, column: str, text: str) -> Column:
    return F.lit(text).cast(df.schema[column].dataType)


def _integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def _number(df: DataFrame, column: str, text: str):
    """The value that an exact text stands for, to compare with others."""
    kind = df.schema[column].dataType
    return int(text) if _integral(df, column) else (
        Decimal(text) if isinstance(kind, T.DecimalType) else float(text))


def _middle(df: DataFrame, column: str, low: str, high: str) -> str:
    a, b = (_number(df, column, x) for x in (low, high))
    if isinstance(a, int):
        return str((a + b) // 2)
    kind = df.schema[column].dataType
    if isinstance(a, Decimal):
        return str(((a + b) / 2).quantize(Decimal(1).scaleb(-kind.scale)))
    return repr(a / 2 + b / 2)


def _in_scope(df: DataFrame, where: Where) -> Column:
    return F.lit(True) if where is None else F.col(where[0]) == _literal(df, *where)


def _piece(df: DataFrame, scope: _Scope) -> Column:
    """2 i + 1 for a value that equals point i, 2 i for one in the gap before
    it, by binary search; -1 for a NULL tie-break."""
    c = F.col(scope.column)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(2 * low)
        mid = (low + high) // 2
        point = _literal(df, scope.column, scope.points[mid])
        return (F.when(c < point, search(low, mid)).when(c == point, F.lit(2 * mid + 1))
                .otherwise(search(mid + 1, high)))

    # A NULL tie-break is a row of its own; a NULL value is no row at all.
    lowest = F.lit(-1 if scope.where else None).cast("int")
    return F.when(_in_scope(df, scope.where), F.when(c.isNull(), lowest).otherwise(
        search(0, len(scope.points))))


def _sketched(df: DataFrame, column: str, when: Column) -> tuple[Column, Column]:
    """The column as a long or a double (the other one NULL), where wanted."""
    c, none = F.when(when, F.col(column)), F.lit(None)
    return ((c.cast("long"), none.cast("double")) if _integral(df, column)
            else (none.cast("long"), c.cast("double")))


def _quantiles(long: str, double: str) -> list[Column]:
    """Evenly spaced quantiles of the two sketches of a group, or NULL."""
    ranks = F.array(*[F.lit(k / BINS) for k in range(BINS + 1)])
    out = []
    for column, agg, get in ((long, F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint),
                             (double, F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double)):
        out.append(F.when(F.count(column) > 0, get(agg(column, SKETCH), ranks)).alias(f"q_{column}"))
    return out


def _count(df: DataFrame, scopes: Sequence[_Scope]) -> list[dict[int, dict]]:
    """One pass: per scope, piece -> rows, smallest and largest value, and the
    quantiles of the values and of the tie-breaks of a point."""
    entries, columns = [], sorted({s.column for s in scopes})
    for i, s in enumerate(scopes):
        wanted = F.col("__x.piece").isin(*s.wanted) if s.wanted else F.lit(False)
        entries.append((i, s, wanted))
    rows = df.select("*", F.explode(F.array(*[
        F.struct(F.lit(i).alias("scope"), _piece(df, s).alias("piece")) for i, s, _ in entries])).alias("__x"))
    rows = rows.where("__x.piece IS NOT NULL")
    fed: dict[str, Column] = {}
    for i, s, wanted in entries:
        own = (F.col("__x.scope") == i) & wanted
        point = F.col("__x.piece") % 2 == 1
        parts = [*zip(("vl", "vd"), _sketched(df, s.column, own & ~point))]
        if s.tie:
            parts += zip(("tl", "td"), _sketched(df, s.tie, own & point))
        for name, value in parts:
            fed[name] = F.coalesce(fed[name], value) if name in fed else value
    names = list(fed)
    rows = rows.select(F.col("__x.scope").alias("__scope"), F.col("__x.piece").alias("__piece"), *columns,
                       *[c.alias(f"__{n}") for n, c in fed.items()])
    ends = [x for c in columns for x in (F.min(c).cast("string").alias(f"low_{c}"),
                                         F.max(c).cast("string").alias(f"high_{c}"))]
    pairs = [("__vl", "__vd")] + ([("__tl", "__td")] if "tl" in names else [])
    quantiles = [q for a, b in pairs for q in _quantiles(a, b)]
    out: list[dict[int, dict]] = [{} for _ in scopes]
    for r in rows.groupBy("__scope", "__piece").agg(F.count(F.lit(1)).alias("n"), *ends, *quantiles).collect():
        s = scopes[r["__scope"]]

        def grid(column: str | None, long: str, double: str) -> list[str]:
            if column is None or f"q_{long}" not in r:
                return []
            values = r[f"q_{long}"] if _integral(df, column) else r[f"q_{double}"]
            return _texts(df, column, values or [])

        out[r["__scope"]][r["__piece"]] = {
            "n": r["n"], "low": r[f"low_{s.column}"], "high": r[f"high_{s.column}"],
            "values": grid(s.column, "__vl", "__vd"), "ties": grid(s.tie, "__tl", "__td")}
    return out


def _texts(df: DataFrame, column: str, values: Iterable) -> list[str]:
    """Quantiles as values of the column's type."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        unit = Decimal(1).scaleb(-kind.scale)
        return [str(Decimal(repr(v)).quantize(unit)) for v in values]
    return [str(int(v)) if _integral(df, column) else repr(float(v)) for v in values]


def _split(df: DataFrame, scope: _Scope, asked: list[tuple[int, list[str], str, str, int]]) -> None:
    """Points of the scope's next pass, from (place in the piece, quantiles,
    smallest, largest value, rows) of its searches."""
    points: set[str] = set()
    spans = []
    for at, grid, low, high, n in asked:
        if grid:
            place, reach = at * BINS / max(n - 1, 1), 1 + BINS // 128
            a, b = grid[max(0, math.floor(place) - reach)], grid[min(BINS, math.ceil(place) + reach)]
            own = {a, grid[min(BINS, round(place))], b}
        else:
            a, b, own = low, high, set()
        if low is not None:
            own.add(_middle(df, scope.column, low, high))    # halves what no sketch can cut
        points |= own
        spans.append((a, b))
    ordered: dict = {}
    for x in sorted(points, key=lambda x: _number(df, scope.column, x)):
        ordered.setdefault(_number(df, scope.column, x), x)
    scope.points = list(ordered.values())
    values = list(ordered)
    scope.wanted = set()
    for a, b in spans:
        if a is None:
            scope.wanted.add(0)
            continue
        low, high = _number(df, scope.column, a), _number(df, scope.column, b)
        scope.wanted |= {2 * i + 1 for i, v in enumerate(values) if low <= v <= high}
        scope.wanted |= {2 * i for i in range(len(values) + 1)
                         if (i == len(values) or values[i] > low) and (i == 0 or values[i - 1] < high)}


def _advance(searches: list[_Search], counted: dict) -> dict:
    """Use one pass's counts: settle, fetch or split further.  Returns what to
    split next: scope -> [(place in the piece, quantiles, low, high, rows)]."""
    asked: dict[tuple, list] = {}
    for s in searches:
        below = 0
        pieces = counted[s.scope]
        for k in sorted(pieces):
            if below + pieces[k]["n"] > s.position:
                break
            below += pieces[k]["n"]
        piece, at = pieces[k], s.position - below
        if k == -1:                                     # the row without a tie-break
            s.found += (None,)
        elif piece["low"] == piece["high"]:
            s.found += (piece["low"],)
            if s.where is None and len(s.columns) > 1:  # the next order: the ties of this value
                s.where, s.position = (s.column, piece["low"]), at
                if piece["n"] <= FETCH:
                    s.fetch = (None, None, 0)
                else:
                    asked.setdefault(s.scope, []).append((at, piece["ties"], None, None, piece["n"]))
        elif piece["n"] <= FETCH:
            s.fetch = (piece["low"], piece["high"], below)
        else:
            asked.setdefault(s.scope, []).append(
                (at, piece["values"], piece["low"], piece["high"], piece["n"]))
    return asked


def _fetch(df: DataFrame, searches: list[_Search]) -> None:
    """Collect the small pieces that the searches ended in, in one scan."""
    cells: dict[tuple, list[_Search]] = {}
    for s in searches:
        cells.setdefault((s.columns, s.scope, s.fetch), []).append(s)
    parts = []
    for i, (columns, (column, where), (low, high, _)) in enumerate(cells):
        inside = _in_scope(df, where)
        if low is not None:
            inside = inside & F.col(column).between(_literal(df, column, low), _literal(df, column, high))
        keys = [F.col(c).cast("string") for c in columns]
        parts.append(F.when(inside, F.struct(F.lit(i).alias("cell"), F.array(*keys).alias("keys"))))
    rows = df.select(F.explode(F.array(*parts)).alias("x")).where("x IS NOT NULL").select("x.*")
    found: list[list] = [[] for _ in cells]
    for r in rows.collect():
        found[r["cell"]].append(r["keys"])
    for keys, own, rows_ in zip(cells, cells.values(), found):
        columns, (column, where), (_, _, below) = keys

        def order(key: list) -> tuple:
            return tuple((x is not None, _number(df, c, x) if x is not None else 0)
                         for c, x in zip(columns, key))

        rows_.sort(key=order)
        for s in own:
            s.found = tuple(rows_[s.position - below])


def _start(df: DataFrame, columns: Sequence[str]) -> tuple[dict, dict]:
    """The first pass: whole columns as single pieces."""
    scopes = {(c, None): _Scope(c, None, None, wanted={0}) for c in columns}
    return scopes, dict(zip(scopes, _count(df, list(scopes.values()))))


def survey(df: DataFrame, columns: Sequence[str]) -> dict[str, dict]:
    """column -> rows with a value (n), smallest and largest one (texts) and
    quantiles, in one scan; ``rows_at`` can begin with it."""
    _, counted = _start(df, columns)
    empty = {"n": 0, "low": None, "high": None, "values": [], "ties": []}
    return {c: counted[c, None].get(0, empty) for c in columns}


def rows_at(df: DataFrame, wanted: dict[str, tuple[Sequence[str], Sequence[int]]],
            known: dict[str, dict] | None = None) -> dict[str, list[list]]:
    """The keys of the rows at given 0-based positions of ascending orders.

    ``wanted``: name -> ((key columns), positions); the key columns are
    numeric, one or two of them (two must be a total order).  Rows whose first
    key is NULL do not count.  Returns the keys as exact text (None for a NULL
    tie-break).  ``df`` should be a stored table or a cheap projection of one;
    ``known`` is the ``survey`` of the first key columns.
    """
    known = known or survey(df, sorted({cols[0] for cols, _ in wanted.values()}))
    searches = {(name, p): _Search(tuple(cols), p) for name, (cols, ps) in wanted.items() for p in ps}
    ties = {s.scope: s.columns[1] for s in searches.values() if len(s.columns) > 1}
    counted = {(c, None): {0: piece} for c, piece in known.items()}
    open_ones = list(searches.values())
    while open_ones:
        asked = _advance(open_ones, counted)
        if small := [s for s in open_ones if s.fetch]:
            _fetch(df, small)
        open_ones = [s for s in open_ones if len(s.found) < len(s.columns)]
        if not open_ones:
            break
        scopes: dict[tuple, _Scope] = {}
        for scope, requests in asked.items():
            column, where = scope
            scopes[scope] = _Scope(column, where, ties.get(scope) if where is None else None)
            _split(df, scopes[scope], requests)
        counted = dict(zip(scopes, _count(df, list(scopes.values()))))
    return {name: [list(searches[name, p].found) for p in ps] for name, (_, ps) in wanted.items()}


def tile_starts(n: int, k: int) -> list[int]:
    """0-based first positions of tiles 2..k of NTILE(k) over ``n`` rows."""
    q, r = divmod(n, k)
    return [p for j in range(1, k) if (p := j * q + min(j, r)) < n]


def add_ntiles(df: DataFrame, specs: dict[str, Sequence[str]], k: int, stored: bool = False,
               known: dict[str, dict] | None = None) -> DataFrame:
    """NTILE(k) columns, one per ``out -> ascending (value, tie-break)``.

    The input is stored once, unless it is a table already; the k - 1 rows
    where a tile begins are found and every row is compared with them.
    Values must not be NULL; one tie-break of each value may be.  ``known`` is
    the ``survey`` of the value columns."""
    if not stored:
        df = reliable(df)
    known = known or survey(df, sorted({keys[0] for keys in specs.values()}))
    starts = tile_starts(max((x["n"] for x in known.values()), default=0), k)
    cuts = rows_at(df, {out: (keys, starts) for out, keys in specs.items()}, known) if starts else {}
    for out, keys in specs.items():
        tile = F.lit(1).cast("long")
        for cut in cuts.get(out, []):
            at_least = F.lit(True)
            for c, v in reversed(list(zip(keys, cut))):
                if v is None:               # the first row of its value
                    continue
                bound = _literal(df, c, v)
                at_least = (F.col(c) > bound) | ((F.col(c) == bound) & at_least)
            tile = tile + F.coalesce(at_least, F.lit(False)).cast("long")
        df = df.withColumn(out, tile)
    return df


def percentiles_cont(df: DataFrame, columns: Sequence[str], p: float) -> dict[str, float | None]:
    """Exact PERCENTILE_CONT(p) of several columns of a stored table."""
    known = survey(df, columns)
    wanted, share = {}, {}
    for c in columns:
        if size := known[c]["n"]:
            at = (size - 1) * p
            low, high = math.floor(at), math.ceil(at)
            wanted[c] = ((c,), sorted({low, high}))
            share[c] = at - low
    found = rows_at(df, wanted, known) if wanted else {}
    out: dict[str, float | None] = {c: None for c in columns}
    for c, keys in found.items():
        low, high = float(keys[0][0]), float(keys[-1][0])
        out[c] = low + (high - low) * share[c]
    return out


def percentile_cont(df: DataFrame, column: str, p: float) -> float | None:
    """Exact PERCENTILE_CONT(p) of one column (NULLs skipped)."""
    return percentiles_cont(reliable(df.select(column)), [column], p)[column]
