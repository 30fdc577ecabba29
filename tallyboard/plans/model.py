"""The logical inputs a metric job reads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Snapshot = Callable[[str], "DataFrame | None"]


def _no_snapshot(table: str) -> DataFrame | None:
    return None


@dataclass(frozen=True)
class Workspace:
    """Events and dimensions, plus optional pre-computed parts.

    ``activity`` / ``touches``: daily roll-ups (see ``rollups``) read in place of events.
    ``spaces``: last act per user and space as of some dates (see ``rankings.space_state``).
    ``masks``: active days per user as of every report date (see ``operators.masks``).
    ``snapshot``: earlier rows of a result table, for jobs that look back at themselves.
    ``zone``: zone that defines displayed event times.
    """

    events: DataFrame
    users: DataFrame
    membership: DataFrame | None = None
    departments: DataFrame | None = None
    user_dep: DataFrame | None = None
    files: DataFrame | None = None
    activity: DataFrame | None = None
    touches: DataFrame | None = None
    spaces: DataFrame | None = None
    masks: DataFrame | None = None
    snapshot: Snapshot = field(default=_no_snapshot)
    zone: str = "UTC"

    def with_(self, **changes) -> "Workspace":
        return replace(self, **changes)

    def need(self, name: str) -> DataFrame:
        frame = getattr(self, name)
        if frame is None:
            raise ValueError(f"this job needs the '{name}' input")
        return frame


def user_teams(users: DataFrame, seats_only: bool = False, *extra: str) -> DataFrame:
    """Users that belong to a team, keyed like events (text id). ``users.id`` is unique."""
    keep = users.filter(F.col("team_id").isNotNull())
    if seats_only:
        keep = keep.filter(F.col("is_seat") == 1)
    return keep.select(F.col("id").cast("string").alias("user_id"), "team_id", *extra)


def enrich_events(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events with the current team and the name of their user.

    The event's own ``team_id`` is unreliable and is replaced. Deleted users keep their
    team; it is today's team, not the team at the time of the event.
    """
    who = users.select(F.col("id").cast("string").alias("user_id"), "team_id",
                       F.col("name").alias("user_name"))
    return events.drop("team_id").join(who, "user_id", "left")
