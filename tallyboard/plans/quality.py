"""Data-quality audits."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import predicates as p
from ..operators.aggregates import duplicate_keys, row_counts
from ..operators.periods import Span


def duplicate_file_guids(files: DataFrame) -> DataFrame:
    return duplicate_keys(files, ["guid"])


def duplicate_users(users: DataFrame) -> DataFrame:
    """Metrics rely on one row per user; this must be empty."""
    return duplicate_keys(users, ["id"])


def teams_with_several_memberships(membership: DataFrame) -> DataFrame:
    """These teams get several rows in the seat table."""
    live = membership.filter(F.col("category").isin(*p.ENTERPRISE_CATEGORIES)
                             & F.col("deleted_at").isNull())
    return duplicate_keys(live, ["target_id"])


def table_row_counts(tables: Mapping[str, DataFrame], span: Span) -> DataFrame:
    """Rows per result table within the report dates of ``span``."""
    return row_counts({n: t.filter(span.covers()) for n, t in tables.items()})
