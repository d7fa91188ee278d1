"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# SQL trim() only knows the space; this removes every Unicode blank and the four separators
# U+001C..U+001F, at both ends.
_BLANK_ENDS = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def strip(value: Column) -> Column:
    return F.regexp_replace(value.cast("string"), _BLANK_ENDS, "")


def blank(value: Column) -> Column:
    """True for null and for text with nothing but blanks; never null itself."""
    return F.coalesce(strip(value) == "", F.lit(True))


def tuple_text(columns: list[Column]) -> Column:
    """One text per distinct tuple, nulls included: different tuples give different texts."""
    parts = [
        F.coalesce(
            F.replace(
                F.replace(c.cast("string"), F.lit("~"), F.lit("~0")), F.lit("|"), F.lit("~1")
            ),
            F.lit("~2"),
        )
        for c in columns
    ]
    return F.concat_ws("|", *parts)
