"""Shared roll-ups: one pass over the raw events feeds every metric.

Every usage counter asks only for the act, the file type and the share flag of an event,
while team, department and seat come from its user. So events are first counted per user;
dimensions are joined to those counts. The raw stream is shuffled once, as partial sums, a
hot user or team costs no more than any other, and no join ever sees raw events.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..operators.masks import MASK_DAYS, days_active
from ..operators.periods import Span
from ..schemas import PRODUCTS
from .model import Workspace

Condition = Callable[[], Column]

# What the counters ask for; ``acts`` and ``guid_acts`` weigh a row (1 for a raw event).
KIND = ("action_name", "file_type", "sub_type", "shared")


def _shares() -> Column:
    return F.col("shared")


def _creates(product_name: str) -> Condition:
    return lambda: p.action(p.CREATE, p.UPLOAD) & p.product(product_name)


def _creates_to_date(product_name: str) -> Condition:
    act = p.UPLOAD if product_name == "clouds" else p.CREATE
    return lambda: p.action(act) & p.product(product_name)


# Counters over rows.
ROW_COUNTERS: dict[str, Condition] = {
    "add_collaborations": lambda: p.action(p.ADD_COLLABORATOR),
    "use_ats": lambda: p.action(p.AT),
    "public_shares": _shares,
    "comments": lambda: p.action(p.COMMENT),
    "file_views": lambda: p.action(p.VIEW),
    "create_file_acts": p.creates_file,
}

# Counters over rows with a guid.
GUID_COUNTERS: dict[str, Condition] = {
    "create_files": p.creates_file,
    "import_files": p.imports_file,
    "upload_files": p.uploads_cloud_file,
    "create_dirs": lambda: p.creates_container(p.FOLDER),
    "create_spaces": lambda: p.creates_container(p.SPACE),
    "create_objs": lambda: p.action(p.CREATE, p.UPLOAD) & p.any_product(),
    **{f"create_{n}": _creates(n) for n in PRODUCTS},
    "td_create_objs": lambda: p.action(p.CREATE) & p.any_product(),
    **{f"td_create_{n}": _creates_to_date(n) for n in PRODUCTS},
    "td_public_shares": _shares,
}


def _acted() -> Column:
    return (p.action(p.ADD_COLLABORATOR, p.AT, p.COMMENT, p.VIEW) | _shares() | p.creates_file())


# Which rows a metric looks at; they also decide which groups appear in its result.
ROWS: dict[str, Condition] = {
    "any": lambda: F.lit(True),
    "clean": p.clean,
    "file": lambda: p.clean() & (p.creates_file() | p.imports_file() | p.uploads_cloud_file()),
    "collaboration": lambda: p.clean() & _acted(),
    "product": lambda: p.action(p.CREATE, p.UPLOAD) & p.any_product(),
    "to_date": lambda: p.action(p.CREATE, p.VIEW, p.ADD_COLLABORATOR, p.AT, p.PUBLIC_SHARE,
                                p.COMMENT, p.UPLOAD),
    "usage": lambda: p.clean() & (p.action(p.CREATE, p.IMPORT) | p.uploads_cloud_file() | _acted()),
    "creation": lambda: p.clean() & p.action(p.CREATE, p.UPLOAD),
}


def _counter(name: str) -> Column:
    condition, weight = ((ROW_COUNTERS[name], "acts") if name in ROW_COUNTERS
                         else (GUID_COUNTERS[name], "guid_acts"))
    return F.sum(F.when(condition(), F.col(weight)).otherwise(0)).alias(name)


def weighted(events: DataFrame) -> DataFrame:
    """Raw events in the form of the activity roll-up, each with weight 1."""
    return events.select("ldate", "user_id", "action_name", "file_type", "sub_type",
                         F.coalesce(p.shares_publicly(), F.lit(False)).alias("shared"),
                         F.lit(1).cast("bigint").alias("acts"),
                         F.col("guid").isNotNull().cast("bigint").alias("guid_acts"))


def activity_rollup(events: DataFrame) -> DataFrame:
    """Per (day, user, kind of event): events, and events with a guid.

    Exact for every counter and far smaller than the events: a user has at most a few
    dozen kinds of event in a day.
    """
    return (weighted(events).groupBy("ldate", "user_id", *KIND)
            .agg(F.sum("acts").alias("acts"), F.sum("guid_acts").alias("guid_acts")))


def touch_rollup(events: DataFrame) -> DataFrame:
    """Per (day, user, guid): file views and the time of the last act on a space."""
    viewed = p.any_product() & p.action(p.VIEW)
    space = p.file_type(p.FOLDER_OR_SPACE) & (F.col("sub_type") == p.SPACE)
    return (events.filter(viewed | space).groupBy("ldate", "user_id", "guid")
            .agg(F.count(F.when(viewed, F.lit(1))).alias("views"),
                 F.max(F.when(space, F.col("time"))).alias("space_time")))


def user_counts(ws: Workspace, rows: str, counters: Sequence[str], span: Span, days: int) -> DataFrame:
    """Per (report date, user) counters over the trailing window of each report date."""
    source = ws.activity if ws.activity is not None else weighted(ws.events)
    hits = source.filter(span.covers(days)).filter(ROWS[rows]())
    sums = [_counter(c) for c in counters]
    if span.single:
        return hits.groupBy("user_id").agg(*sums).withColumn("ldate", F.lit(span.start))
    daily = hits.groupBy("ldate", "user_id").agg(*sums)
    return span.on_report_dates(daily, ["user_id"], list(counters), days)


def user_active_days(ws: Workspace, span: Span, days: int) -> DataFrame:
    """Per (report date, user): on how many days of the window the user did anything.

    With ``ws.masks`` one row per report date and user is read, whatever the window.
    """
    if ws.masks is not None and days <= MASK_DAYS:
        return (ws.masks.filter(span.covers())
                .select("ldate", "user_id", days_active(days).cast("bigint").alias("active_days"))
                .filter("active_days > 0"))
    source = ws.activity if ws.activity is not None else ws.events
    seen = (source.filter(span.covers(days)).select("ldate", "user_id").distinct()
            .withColumn("active_days", F.lit(1)))
    return span.on_report_dates(seen, ["user_id"], ["active_days"], days)


def user_touches(ws: Workspace, span: Span, days: int) -> DataFrame:
    """Per (report date, user, guid): file views over the trailing window."""
    keys = ["user_id", "guid"]
    if ws.touches is not None:
        daily = (ws.touches.filter(span.covers(days) & (F.col("views") > 0))
                 .select("ldate", *keys, "views"))
    else:
        hits = ws.events.filter(span.covers(days)).filter(p.any_product() & p.action(p.VIEW))
        one = F.count(F.lit(1)).alias("views")
        if span.single:
            return hits.groupBy(*keys).agg(one).withColumn("ldate", F.lit(span.start))
        daily = hits.groupBy("ldate", *keys).agg(one)
    return span.on_report_dates(daily, keys, ["views"], days)
