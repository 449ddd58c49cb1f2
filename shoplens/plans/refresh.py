"""Rebuild of the dates that an ingest touched, not of whole layers.

The dated layers (staging, fact, sessions, funnel) of a version are made of
parts.  The first part holds a whole layer; each later one owns some dates and
stands for everything that the parts before it hold of them.  A new version
adds one part per layer to those of the version before it, so untouched dates
are neither read, written nor copied.

Which dates a layer has to rewrite follows from the dates whose events changed:

* staging: those dates;
* fact and funnel: also every date with events of a user whose first date has
  moved, in either direction (a replaced date can lose a user's first events);
* sessions: the dates on which a session with events on a touched date, before
  or after the change, began or begins now.

All of it is found by joins on the small side of the change; only dates (at
most one value per calendar day) reach the driver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoplens.plans import facts

MAX_PARTS = 16          # beyond this a version is built anew, with one part a layer
MAX_SHARE = 0.5         # of all dates: rewriting more is no cheaper than building anew
DATED = {"clean": "event_date", "fact": "event_date", "sessions": "session_date", "funnel": "event_date"}
SESSION = ("user_session", "user_id")


@dataclass(frozen=True)
class Part:
    """A folder and the dates that it owns (None: all).  Without a folder the
    dates have no rows."""
    path: str | None
    dates: tuple[dt.date, ...] | None = None


def parts_of(version: dict, layer: str) -> list[Part]:
    """The parts of a published version's layer."""
    stored = (version.get("parts") or {}).get(layer)
    if not stored:
        return [Part(f"{version['path']}/{layer}")]
    return [Part(p["path"], None if p["dates"] is None else tuple(p["dates"])) for p in stored]


def stored_parts(parts: dict[str, list[Part]]) -> dict[str, list[tuple]]:
    """As the log of versions holds them."""
    return {layer: [(p.path, None if p.dates is None else list(p.dates)) for p in of]
            for layer, of in parts.items()}


def _owned(parts: list[Part]) -> list[tuple[Part, list[dt.date]]]:
    """Each part with a folder, and the dates that later parts own."""
    out, later = [], set()
    for part in reversed(parts):
        if part.path:
            out.append((part, sorted(later)))
        later.update(part.dates or ())
    return out[::-1]


def on_dates(df: DataFrame, column: str, dates: Iterable[dt.date]) -> DataFrame:
    return df.where(F.col(column).isin(list(dates)))


def off_dates(df: DataFrame, column: str, dates: Iterable[dt.date]) -> DataFrame:
    dates = list(dates)
    return df.where(~F.col(column).isin(dates)) if dates else df


def read_parts(spark: SparkSession, parts: list[Part], column: str) -> DataFrame:
    """A layer from its parts; the filters on the folder column prune folders."""
    frames = [off_dates(spark.read.parquet(part.path), column, later) for part, later in _owned(parts)]
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole


def select_parts(parts: list[Part], column: str, columns: list[str]) -> str:
    """The same as SQL, for a lasting view."""
    names = ", ".join(f"`{c}`" for c in columns)
    branches = []
    for part, later in _owned(parts):
        days = ", ".join(f"DATE'{d.isoformat()}'" for d in later)
        where = f" WHERE `{column}` NOT IN ({days})" if later else ""
        branches.append(f"SELECT {names} FROM parquet.`{part.path}`{where}")
    return " UNION ALL ".join(branches)


def first_dates(old_first: DataFrame, old_fact: DataFrame, touched_stg: DataFrame,
                touched: list[dt.date]) -> DataFrame:
    """The users' first dates after the touched dates changed: the old one
    where its date stays, otherwise the next date that the user still has, or
    a touched date.  What such users still have lies after the first touched
    date, so only later folders are read: none if new dates were appended."""
    lost = on_dates(old_first, "first_event_date", touched).select("user_id")
    later = old_fact.where(F.col("event_date") > F.lit(min(touched))).select("user_id", "event_date")
    next_date = facts.user_first_dates(off_dates(later, "event_date", touched)
                                       .join(lost, "user_id", "left_semi"))
    return (off_dates(old_first, "first_event_date", touched)
            .unionByName(next_date).unionByName(facts.user_first_dates(touched_stg))
            .groupBy("user_id").agg(F.min("first_event_date").alias("first_event_date")))


def dates_to_tag(old_first: DataFrame, new_first: DataFrame, old_fact: DataFrame,
                 touched: list[dt.date]) -> list[dt.date]:
    """The touched dates and those with events of a user whose first date moved."""
    before = old_first.withColumnRenamed("first_event_date", "_before")
    moved = before.join(new_first, "user_id").where("_before <> first_event_date")
    # Their events begin at their old first dates: earlier folders stay unread.
    low = moved.agg(F.min("_before")).first()[0]
    if low is None:
        return touched
    rows = off_dates(old_fact.where(F.col("event_date") >= F.lit(low)).select("user_id", "event_date"),
                     "event_date", touched)
    again = rows.join(moved.select("user_id"), "user_id", "left_semi").select("event_date").distinct().collect()
    return sorted({*touched, *(r["event_date"] for r in again)})


def _with_keys(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join on the session keys, for which NULL is a value."""
    keys = keys.select(*[F.col(c).alias(f"_{c}") for c in SESSION])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in SESSION]
    return df.join(keys, same[0] & same[1], how)


def changed_sessions(old_sessions: DataFrame, old_fact: DataFrame, new_fact: DataFrame,
                     touched: list[dt.date], store) -> tuple[DataFrame, list[dt.date]]:
    """(rows, dates): the sessions that begin on ``dates``, all dates on which
    sessions differ from the old ones among them.  ``store`` cuts the lineage
    of a table that is read several times."""
    keys = store(on_dates(old_fact, "event_date", touched).select(*SESSION)
                 .unionByName(on_dates(new_fact, "event_date", touched).select(*SESSION)).distinct())
    before = (_with_keys(old_sessions, keys, "left_semi")
              .groupBy("session_date").agg(F.max(F.to_date("session_end")).alias("end")).collect())
    # All events of these sessions lie between their old ends or on touched dates.
    low = min([*touched, *(r["session_date"] for r in before)])
    high = max([*touched, *(r["end"] for r in before)])
    near = new_fact.where(F.col("event_date").between(F.lit(low), F.lit(high)))
    now = store(facts.fact_sessions(_with_keys(near, keys, "left_semi")))
    begin = now.select("session_date").distinct().collect()
    dates = sorted({r["session_date"] for r in [*before, *begin]})
    others = _with_keys(on_dates(old_sessions, "session_date", dates), keys, "left_anti")
    return others.select(*now.columns).unionByName(now), dates
