"""Linear scores over usage counters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

c = F.col


def active_score() -> Column:
    """views + 10 per created file + 5 per collaboration act."""
    acts = c("add_collaborations") + c("public_shares") + c("comments") + c("use_ats")
    return c("file_views") + c("create_files") * 10 + acts * 5


def saved_days() -> Column:
    """Working time saved, in days, from minutes per act."""
    minutes = (c("file_views") + c("create_objs") * 30 + c("public_shares") * 10
               + c("add_collaborations") * 15 + c("comments") * 3)
    return minutes / (60 * 24)


def auto_saves() -> Column:
    return c("add_collaborations") * 7 + c("public_shares") * 10 + c("comments") * 15
