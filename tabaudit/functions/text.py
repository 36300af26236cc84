"""Text cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Spellings of a missing entry, matched exactly and before trimming.
SENTINELS = ("?", " ?")

# Fixed value: the category that stands for a missing entry after cleaning.
MISSING_TOKEN = "nan"

# Every character Unicode text processing treats as white space.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)


def sentinel_to_null(col: Column) -> Column:
    """Null where the text is exactly a missing-value spelling."""
    return F.when(~col.isin(*SENTINELS), col)


def strip_text(col: Column) -> Column:
    """Drop white space at both ends, then every trailing dot (in that order, once)."""
    return F.rtrim(F.btrim(col, F.lit(WHITE_SPACE)), F.lit("."))


def clean_text(col: Column, missing_token: str | None = MISSING_TOKEN) -> Column:
    """The full text chain; a missing entry becomes ``missing_token`` unless that is None."""
    cleaned = strip_text(col.cast("string"))
    return cleaned if missing_token is None else F.coalesce(cleaned, F.lit(missing_token))
