"""One definition of every coded condition used by the metrics.

Fixed values of the event protocol (they decide results, so they are spelled out):

* ``action_name``: create_obj, import_obj, upload_obj, view_file, add_collaborator, at,
  public_share, comment
* ``file_type``: 0 unknown, 1 folder or space, 2 document, 3 cloud file
* ``sub_type`` of a folder/space: 1 folder, 2 space; of a document: see PRODUCT_SUBTYPES
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .scalars import DateLike, as_date, json_raw_token

CREATE, IMPORT, UPLOAD, VIEW = "create_obj", "import_obj", "upload_obj", "view_file"
ADD_COLLABORATOR, AT, PUBLIC_SHARE, COMMENT = "add_collaborator", "at", "public_share", "comment"

UNKNOWN, FOLDER_OR_SPACE, DOCUMENT, CLOUD_FILE = 0, 1, 2, 3
FOLDER, SPACE = 1, 2

PRODUCT_SUBTYPES: dict[str, tuple[int, ...]] = {
    "docxs": (0, -2),
    "sheets": (-1, -3, -4),
    "tables": (-8,),
    "ppts": (-5, -10),
    "docs": (-6,),
    "others": (-7, -9),
}

# Membership categories that are enterprises.
ENTERPRISE_CATEGORIES = (2, 3, 4)


def action(*names: str) -> Column:
    c = F.col("action_name")
    return c == names[0] if len(names) == 1 else c.isin(*names)


def file_type(*types: int) -> Column:
    c = F.col("file_type")
    return c == types[0] if len(types) == 1 else c.isin(*types)


def clean() -> Column:
    """Rows whose file type is known."""
    return F.col("file_type") != UNKNOWN


def has_team() -> Column:
    return F.col("team_id").isNotNull()


def creates_file() -> Column:
    return action(CREATE) & (F.col("file_type") != FOLDER_OR_SPACE)


def imports_file() -> Column:
    return action(IMPORT)


def uploads_cloud_file() -> Column:
    return action(UPLOAD) & file_type(CLOUD_FILE)


def creates_container(sub_type: int) -> Column:
    return action(CREATE) & file_type(FOLDER_OR_SPACE) & (F.col("sub_type") == sub_type)


def shares_publicly() -> Column:
    return action(PUBLIC_SHARE) & (json_raw_token(F.col("extend_info"), "status") == "1")


def product(name: str, type_col: str = "file_type", sub_col: str = "sub_type") -> Column:
    """Membership of a file in one product bucket."""
    if name == "clouds":
        return F.col(type_col) == CLOUD_FILE
    return (F.col(type_col) == DOCUMENT) & F.col(sub_col).isin(*PRODUCT_SUBTYPES[name])


def any_product(type_col: str = "file_type") -> Column:
    return F.col(type_col).isin(DOCUMENT, CLOUD_FILE)


# --- date windows -----------------------------------------------------------
def on_day(d: DateLike) -> Column:
    return F.col("ldate") == F.lit(as_date(d))


def trailing(d: DateLike, days: int) -> Column:
    """The ``days`` days that end with ``d``, both ends included."""
    end = F.lit(as_date(d))
    return F.col("ldate").between(F.date_sub(end, days - 1), end)


def up_to(d: DateLike) -> Column:
    return F.col("ldate") <= F.lit(as_date(d))


def days_before(d: DateLike, n: int) -> Column:
    return F.col("ldate") == F.date_sub(F.lit(as_date(d)), n)
