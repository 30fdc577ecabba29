"""Small hand-made inputs."""

import datetime as dt

from pyspark.sql import Row

from tallyboard import schemas
from tallyboard.plans.model import Workspace

DAY = dt.date(2024, 1, 15)


def millis(d: dt.date, seconds: int = 0) -> int:
    return int(dt.datetime(d.year, d.month, d.day, tzinfo=dt.timezone.utc).timestamp() + seconds) * 1000


def event(user="1", action="view_file", kind=2, sub=0, guid="g", day=DAY, info="{}", seconds=0, time=None):
    t = millis(day, seconds) if time is None else time
    return (day, "e", guid, user, "d", kind, sub, t, action, None, "ua", info, 0)


def events(spark, rows):
    return spark.createDataFrame(rows, schemas.STORED_EVENT)


def users(spark, rows):
    """rows: (id, team, seat) or full tuples."""
    full = [r if len(r) == 6 else (r[0], f"u{r[0]}", r[1], r[2], dt.datetime(2023, 1, 1), None) for r in rows]
    return spark.createDataFrame(full, schemas.USERS)


def workspace(spark, event_rows, user_rows=((1, 10, 1),), **parts):
    return Workspace(events(spark, event_rows), users(spark, list(user_rows)), **parts)


def membership(spark, rows):
    return spark.createDataFrame([(*r, None) for r in rows], schemas.MEMBERSHIP)


def user_dep(spark, rows):
    return spark.createDataFrame(rows, schemas.USER_DEP)


def files(spark, rows):
    """rows: (guid, name, type, sub_type)."""
    return spark.createDataFrame(
        [(g, n, t, s, 0, "1", -1, "null", -1, "null", "space") for g, n, t, s in rows], schemas.FILES)


def edges(spark, pairs, removed=(), links=()):
    """pairs: ((type, id), (parent type, parent id))."""
    return spark.createDataFrame(
        [(a[0], a[1], b[0], b[1], 0, 0, (a, b) in links, (a, b) in removed) for a, b in pairs], schemas.EDGE)


def one(df) -> Row:
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def as_set(df, *cols):
    return {tuple(r) for r in df.select(*cols).collect()}
