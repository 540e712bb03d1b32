"""Surrogate keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: text standing for NULL inside a key.
NULL_TEXT = "_dbt_utils_surrogate_key_null_"


def timestamp_text(col: Column) -> Column:
    """Timestamp as text with six fraction digits, always the same width."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def surrogate_key(*cols: str | Column) -> Column:
    """MD5 of the columns' texts joined with '-', NULLs replaced by a fixed text.

    Pass timestamps through :func:`timestamp_text`; a plain cast drops trailing
    zeros and would give the same instant different texts.
    """
    texts = [
        F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_TEXT))
        for c in cols
    ]
    return F.md5(F.concat_ws("-", *texts))
