"""Active users per team over any window, from stored daily bitmaps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.bitmaps import daily_bitmaps, number_members, sliding_distinct
from ..operators.periods import Span
from ..sources.scratch import cut_lineage
from ..sources.store import Store
from .model import Workspace, user_teams

NUMBERS, BITMAPS = "team_member_numbers", "daily_team_bitmaps"


def refresh_bitmaps(store: Store, ws: Workspace, span: Span, days: int = 30,
                    late: list[dt.date] | None = None) -> list[dt.date]:
    """Bring the bitmaps that reports of ``span`` look at up to date; returns the days written.

    An event counts for the user's team of today. So besides missing days and ``late`` ones (days with
    rows that came late) those days are made again on which a user was active who joined, left or
    came back to a team since the last run; they are found by a semi-join of the few such users with
    (day, user) of the stored days. One row per day reaches the driver.

    Numbers are written before the bitmaps, with the pairs that were live; a run that breaks in between
    leaves the old live marks, which are replaced last, so the next run finds the same changes.
    """
    source = ws.activity if ws.activity is not None else ws.events
    seen = source.select("ldate", "user_id")
    live = cut_lineage(user_teams(ws.users).distinct())
    stored = store.exists(store.path(NUMBERS))
    before = store.read_dimension(f"{NUMBERS}_live") if store.exists(store.path(f"{NUMBERS}_live")) else None
    numbers = cut_lineage(number_members(live, "team_id", "user_id",
                                         store.read_dimension(NUMBERS) if stored else None))
    store.replace(numbers, NUMBERS)

    wanted = Span(span.start - dt.timedelta(days - 1), span.end)
    kept = store.days(BITMAPS)
    stale = {d for d in wanted.dates() if d not in kept} | {d for d in late or () if wanted.start <= d <= wanted.end}
    if kept and before is not None:
        keys = ["team_id", "user_id"]
        moved = cut_lineage(live.join(before, keys, "left_anti").unionByName(
            before.join(live, keys, "left_anti")).select("user_id").distinct())
        # every stored day, not only those of this span: a later run may look at them without a change to see
        touched = seen.filter(F.col("ldate").isin(kept)).join(moved, "user_id", "left_semi")
        stale |= {r["ldate"] for r in touched.select("ldate").distinct().collect()}
    if stale:
        now = numbers.join(live, ["team_id", "user_id"], "left_semi")
        rows = daily_bitmaps(seen.filter(F.col("ldate").isin(sorted(stale))), now, "team_id", "user_id")
        store.write_listed(rows, BITMAPS, sorted(stale))
    store.replace(live, f"{NUMBERS}_live")
    return sorted(stale)


def active_users(store: Store, span: Span, days: int) -> DataFrame:
    """``ldate``, ``team_id``, ``active_uv``: users active in the ``days`` up to each report date."""
    return sliding_distinct(store.read(BITMAPS), "team_id", span, days, "active_uv")
