"""The daily jobs in run order, and the backfill over a date range."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.masks import MASK_DAYS, advance
from ..operators.periods import Span
from ..sources.store import Store
from . import enterprise, rankings, usage
from .files import merge_files
from .journal import Journal, state_of
from .model import Workspace
from .org import user_departments
from .rollups import activity_rollup, touch_rollup

Job = Callable[[Workspace, Span], DataFrame]


def _usage(metric: usage.UsageMetric) -> Job:
    return lambda ws, span: usage.usage(ws, metric, span)


# Run order matters at the end: the creation report reads the two tables before it.
JOBS: dict[str, Job] = {
    **{m.table: _usage(m) for m in (
        usage.FILE_BY_TEAM, usage.FILE_BY_DEPARTMENT, usage.FILE_BY_MEMBER,
        usage.COLLAB_BY_TEAM, usage.COLLAB_BY_DEPARTMENT, usage.COLLAB_BY_MEMBER,
        usage.COLLAB_30D_BY_MEMBER,
        usage.PRODUCT_BY_TEAM, usage.PRODUCT_BY_DEPARTMENT, usage.PRODUCT_BY_MEMBER)},
    enterprise.USERS_TABLE: enterprise.seats_and_activity,
    enterprise.TOTALS_TABLE: enterprise.usage_to_date,
    rankings.HOT_1D: lambda ws, span: rankings.hot_files(ws, span, 1),
    rankings.HOT_7D: lambda ws, span: rankings.hot_files(ws, span, 7),
    rankings.SPACES: rankings.updated_spaces,
    "usage_1d_download_by_member": usage.member_usage_download,
    enterprise.CREATION_TABLE: enterprise.creation_download,
}

ACTIVITY, TOUCHES = "daily_user_activity", "daily_file_touches"
SPACE_STATE = "daily_space_state"
MASK_STATE = "daily_active_masks"
FROM_TOUCHES = (rankings.HOT_1D, rankings.HOT_7D, rankings.SPACES)


def refresh_dimensions(store: Store, edges: DataFrame, current_files: DataFrame,
                       legacy_files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rebuild and store the user-department bridge and the file dimension.

    Runs before the metric jobs, which then read the stored tables.
    """
    store.replace(user_departments(edges), "user_dep")
    store.replace(merge_files(current_files, legacy_files), "files")
    return store.read_dimension("user_dep"), store.read_dimension("files")


# Days of raw events that one report looks at; the widest table of a run sets the look-back.
WINDOW_DAYS: dict[str, int] = {
    **{m.table: m.days for m in (
        usage.FILE_BY_TEAM, usage.FILE_BY_DEPARTMENT, usage.FILE_BY_MEMBER,
        usage.COLLAB_BY_TEAM, usage.COLLAB_BY_DEPARTMENT, usage.COLLAB_BY_MEMBER,
        usage.COLLAB_30D_BY_MEMBER,
        usage.PRODUCT_BY_TEAM, usage.PRODUCT_BY_DEPARTMENT, usage.PRODUCT_BY_MEMBER)},
    enterprise.USERS_TABLE: 14, enterprise.CREATION_TABLE: 14,
}
WIDEST = 30
LEDGER, LEDGER_SCHEMA = "_days", "ldate date, events long"


@dataclass(frozen=True)
class Backfill:
    """Runs jobs over start..end and stores their rows.

    Each roll-up has a ledger of the days it holds and of the events each day had when it was
    rolled up. A run brings every day that its reports look at up to date: days that are missing,
    whatever the gap since the last run, and days whose number of events has changed since, because
    rows came late. A day rewritten with as many rows as before is not noticed; ``refresh`` rolls
    up all days again. ``bulk`` computes all dates of a job in one Spark job; without it the dates
    run one by one. Both give the same rows.

    ``catch_up`` also computes the stored reports before the span again, from the first day on
    that had late rows. ``serve(task, date, rows)`` is called for each task and date after its
    rows are stored, to hand them to a serving database.

    ``carry_spaces`` keeps the last act per space from run to run, so that the list of updated
    spaces reads the days of the span instead of all history. A state that late rows have made
    stale is folded anew.

    ``carry_masks`` keeps each user's active days of the last 30 as one integer per day, so that
    active users over any such window take one day's events and the masks of the day before.

    With a ``name`` the run keeps a journal in the store. When it breaks, a run of the same name and arguments
    goes on: what it has stored (and served) is not computed again, unless late rows have changed the roll-ups
    since. A step that broke half-way is done again whole. Dimensions are taken to be those of the first start.
    ``refresh`` does all steps again.
    """

    ws: Workspace
    store: Store
    bulk: bool = True
    refresh: bool = False
    carry_spaces: bool = False
    carry_masks: bool = False
    catch_up: bool = False
    serve: Callable[[str, dt.date, DataFrame], None] | None = None
    name: str | None = None

    @cached_property
    def journal(self) -> Journal | None:
        return Journal(self.store, self.name) if self.name else None

    def run(self, start, end=None, tasks: Sequence[str] | None = None, lookback: int = 0) -> None:
        """``lookback`` may lengthen the look-back that the tasks need, never shorten it."""
        span = Span.of(start, end)
        unknown = [t for t in tasks or () if t not in JOBS]
        if unknown:
            raise KeyError(f"unknown tasks: {unknown}")
        wanted = [t for t in JOBS if tasks is None or t in tasks]
        days = max(lookback + 1, MASK_DAYS if self.carry_masks else 1, *(WINDOW_DAYS.get(t, WIDEST) for t in wanted))
        ws, redone = self.with_rollups(span, days, any(t in FROM_TOUCHES for t in wanted), rankings.SPACES in wanted)
        if self.catch_up:
            reported = [d for t in wanted for d in self.store.days(t) if d < span.start and redone and d >= min(redone)]
            if reported:
                span = Span(min(reported), span.end)
                ws, _ = self.with_rollups(span, days, any(t in FROM_TOUCHES for t in wanted), rankings.SPACES in wanted)
        if self.carry_masks and enterprise.USERS_TABLE in wanted:
            ws = self.with_masks(ws, span)
        carry = self.carry_spaces and rankings.SPACES in wanted
        ledgers = {t: self._ledger(t) for t in (ACTIVITY, TOUCHES)} if self.journal else {}
        for part in ([span] if self.bulk else [Span.of(d) for d in span.dates()]):
            state = state_of(ledgers, part.end)
            left = [t for t in wanted if self.refresh or not self.journal or not self.journal.finished(t, part, state)]
            if carry and left:
                ws = self.with_spaces(ws, part, redone)
            for task in left:
                self.store.write_span(JOBS[task](ws, part), task, part)
                if self.serve:
                    for d in part.dates():
                        self.serve(task, d, self.store.read_day(task, d))
                if self.journal:
                    self.journal.finish(task, part, state)

    def with_rollups(self, span: Span, days: int = WIDEST, touches: bool = True,
                     history: bool = True) -> tuple[Workspace, list[dt.date]]:
        """Bring the roll-ups up to date; a workspace that reads them, and the earlier days rolled up again.

        ``history`` covers all days up to the span, which the list of updated spaces looks at.
        """
        start = span.start - dt.timedelta(days - 1)
        redone = self._roll_up(ACTIVITY, activity_rollup, Span(start, span.end), False)
        ws = self.ws.with_(activity=self.store.read(ACTIVITY), snapshot=self.store.snapshot)
        if touches:
            redone = sorted({*redone, *self._roll_up(TOUCHES, touch_rollup, Span(start, span.end), history)})
            ws = ws.with_(touches=self.store.read(TOUCHES))
        return ws, sorted({*redone, *self.journal.late()}) if self.journal else redone

    def _ledger(self, table: str) -> dict[dt.date, int]:
        """Days that a roll-up holds, with the events of each. A ledger whose writing broke off has none."""
        path = self.store.path(table + LEDGER)
        if not self.store.exists(path):
            return {}
        return {r["ldate"]: r["events"] for r in self.store.spark.read.schema(LEDGER_SCHEMA).parquet(path).collect()}

    def _roll_up(self, table: str, rollup, span: Span, history: bool) -> list[dt.date]:
        """Roll up the days of the span (of all history up to its end) that the ledger lacks or has with
        another number of events; returns those that were in the ledger. One row per day reaches the driver."""
        store = self.store
        known = self._ledger(table)
        events = self.ws.events.filter(F.col("ldate") <= F.lit(span.end))
        if not history:
            events = events.filter(F.col("ldate") >= F.lit(span.start))
        found = {r["ldate"]: r["count"] for r in events.groupBy("ldate").count().collect()}
        needed = {*span.dates(), *found} | ({d for d in known if d <= span.end} if history else set())
        stale = sorted(d for d in needed if self.refresh or known.get(d) != found.get(d, 0))
        if not stale:
            return []
        rows = rollup(events.filter(F.col("ldate").isin(stale)))
        store.write_listed(rows, table, stale)
        if table == ACTIVITY:
            for d in store.days(MASK_STATE):
                if any(s <= d and s in known for s in stale):
                    store.drop_day(MASK_STATE, d)
        known, before = known | {d: found.get(d, 0) for d in stale}, set(known)
        if self.journal:
            self.journal.note_late(d for d in stale if d in before)
        # the ledger is written after the days it speaks of: a run that stops in between does them again
        store.replace(store.spark.createDataFrame(sorted(known.items()), LEDGER_SCHEMA).coalesce(1), table + LEDGER)
        return [d for d in stale if d in before]

    def with_masks(self, ws: Workspace, span: Span) -> Workspace:
        """Masks of every date of the span, each from the date before it and the days in between.

        The first one follows from the latest stored date before the span, over whatever gap; without one it is
        made from the roll-up. Masks that late rows made stale were dropped with the roll-up (``_roll_up``).
        """
        store = self.store
        earlier = max((d for d in store.days(MASK_STATE) if d < span.start), default=None)
        for d in span.dates():
            state = store.read_day(MASK_STATE, earlier) if earlier else None
            store.write_day(advance(ws.activity, ["user_id"], d, state, earlier), MASK_STATE, d)
            earlier = d
        for d in store.days(MASK_STATE):
            if d < span.start - dt.timedelta(1):
                store.drop_day(MASK_STATE, d)
        return ws.with_(masks=store.read(MASK_STATE))

    def with_spaces(self, ws: Workspace, span: Span, redone: Sequence[dt.date] = ()) -> Workspace:
        """State of the day before the span (folded from all history on the first run, and when a day up
        to it was rolled up again), and the state of its last day for the run that follows. Older states go."""
        store, eve = self.store, span.start - dt.timedelta(1)
        if not store.exists(store.path(SPACE_STATE, eve)) or any(d <= eve for d in redone):
            store.write_day(rankings.space_state(ws.with_(spaces=None), eve), SPACE_STATE, eve)
        ws = ws.with_(spaces=store.read(SPACE_STATE))
        # folding the span into one date is what the state of its last day is
        last = rankings.fold_spaces(ws, span)
        store.write_day(last, SPACE_STATE, span.end)
        for d in store.days(SPACE_STATE):
            if d < eve:
                store.drop_day(SPACE_STATE, d)
        return ws
