"""File dimension: current files plus the legacy files they do not replace."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import prefer

SPACE_LOC, DESKTOP_LOC = "space", "desktop"


def live_files(source: DataFrame, location: str) -> DataFrame:
    """Live rows of one file table, in the layout of the dimension.

    The update and delete columns hold fixed placeholders (-1 and the text 'null').
    """
    none_at, none_by = F.lit(-1).cast("bigint"), F.lit("null")
    return (source.filter(F.col("guid").isNotNull() & F.col("deleted_at").isNull())
            .select("guid", "name", F.col("type").cast("string").alias("file_type"),
                    F.col("sub_type").cast("string").alias("file_subtype"),
                    "created_at", "created_by",
                    none_at.alias("updated_at"), none_by.alias("updated_by"),
                    none_at.alias("deleted_at"), none_by.alias("deleted_by"),
                    F.lit(location).alias("file_loc")))


def merge_files(current: DataFrame, legacy: DataFrame) -> DataFrame:
    """Current files win over legacy files of the same guid.

    Duplicates inside one source stay; ``quality.duplicate_file_guids`` reports them.
    """
    return prefer(live_files(current, SPACE_LOC), live_files(legacy, DESKTOP_LOC), ["guid"])


def all_files(current: DataFrame, legacy: DataFrame) -> DataFrame:
    """Both file tables, tagged, nothing removed."""
    return (current.withColumn("source", F.lit("file"))
            .unionByName(legacy.withColumn("source", F.lit("file_legacy"))))
