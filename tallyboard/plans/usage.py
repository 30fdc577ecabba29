"""File, collaboration and product usage at team, department and member grain."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import share
from ..functions.scores import active_score
from ..operators.periods import Span
from ..schemas import COLLAB_COUNTS, FILE_COUNTS, PRODUCTS, RESULTS, conform
from .model import Workspace, user_teams
from .rollups import user_counts

_GRAIN = {"team": ["team_id"], "department": ["team_id", "department_id"],
          "member": ["team_id", "user_id"]}


@dataclass(frozen=True)
class UsageMetric:
    """``rows`` names the events it looks at, ``counters`` maps output columns to counters."""

    table: str
    grain: str
    rows: str
    counters: Mapping[str, str]
    days: int = 1
    seats_only: bool = False
    shares_of: str | None = None

    def window(self, days: int) -> "UsageMetric":
        return replace(self, days=days)


_FILE = {c: c for c in FILE_COUNTS}
_COLLAB = {c: "create_file_acts" if c == "create_files" else c for c in COLLAB_COUNTS}
_PRODUCT = {"create_objs": "create_objs", **{f"create_{n}": f"create_{n}" for n in PRODUCTS}}

# Despite their names, the file and collaboration "7d" tables cover one day, as they do
# where they are produced; ``window(7)`` gives the seven-day variant.
FILE_BY_TEAM = UsageMetric("file_7d_statistic_by_global", "team", "clean", _FILE)
FILE_BY_DEPARTMENT = UsageMetric("file_7d_statistic_by_department", "department", "file", _FILE)
FILE_BY_MEMBER = UsageMetric("file_7d_statistic_by_member", "member", "file", _FILE)
COLLAB_BY_TEAM = UsageMetric("collaboration_7d_statistic_by_global", "team", "any", _COLLAB)
COLLAB_BY_DEPARTMENT = UsageMetric("collaboration_7d_statistic_by_department", "department",
                                   "collaboration", _COLLAB)
COLLAB_BY_MEMBER = UsageMetric("collaboration_7d_statistic_by_member", "member",
                               "collaboration", _COLLAB, seats_only=True)
COLLAB_30D_BY_MEMBER = UsageMetric("collaboration_30d_statistic_by_member", "member",
                                   "collaboration", _COLLAB, days=30, seats_only=True)
PRODUCT_BY_TEAM = UsageMetric("file_7d_product_statistic_by_global", "team", "product",
                              _PRODUCT, days=7, shares_of="create_objs")
PRODUCT_BY_DEPARTMENT = replace(PRODUCT_BY_TEAM, grain="department",
                                table="file_7d_product_statistic_by_department")
PRODUCT_BY_MEMBER = replace(PRODUCT_BY_TEAM, grain="member",
                            table="file_7d_product_statistic_by_member")


def usage(ws: Workspace, metric: UsageMetric, span: Span) -> DataFrame:
    """Rows of one usage table for every report date of ``span``."""
    inner = list(dict.fromkeys(metric.counters.values()))
    counts = (user_counts(ws, metric.rows, inner, span, metric.days)
              .join(user_teams(ws.users, metric.seats_only), "user_id"))
    if metric.grain == "department":
        # one row per department of the user, ancestors included
        counts = counts.join(ws.need("user_dep"), "user_id")
    out = counts.groupBy("ldate", *_GRAIN[metric.grain]).agg(
        *[F.expr(f"sum({src}) AS {name}") for name, src in metric.counters.items()])
    if metric.shares_of:
        whole = F.col(metric.shares_of)
        out = out.select("*", *[share(F.col(n), whole).alias(f"{n}_ratio")
                                for n in metric.counters if n != metric.shares_of])
    return conform(out, RESULTS[metric.table])


def member_usage_download(ws: Workspace, span: Span) -> DataFrame:
    """Daily usage and score of every member, one row per department of the member."""
    counters = ("file_views", "use_ats", "add_collaborations", "public_shares", "comments",
                "create_files", "create_spaces", "create_dirs", "import_files", "upload_files")
    counts = user_counts(ws, "usage", counters, span, 1)
    members = user_teams(ws.users, False, F.col("name").alias("user_name"))
    out = (counts.join(members, "user_id").withColumn("active_score", active_score())
           .join(ws.need("user_dep"), "user_id", "left"))
    return conform(out, RESULTS["usage_1d_download_by_member"])
