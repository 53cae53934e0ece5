"""Text helpers: key lists and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OUTER_SPACE = r"^\s+|\s+$"


def key_list(text: Column) -> Column:
    """Comma list to an array of trimmed, lower-case keys, blanks dropped."""
    cleaned = F.transform(
        F.split(text, ","), lambda part: F.lower(F.regexp_replace(part, _OUTER_SPACE, ""))
    )
    return F.filter(cleaned, lambda key: key != "")


def split_keys(text: str) -> list[str]:
    """The same rule for one request parameter; a comparison needs two keys."""
    keys = [key for key in (part.strip().lower() for part in text.split(",")) if key]
    if len(keys) < 2:
        raise ValueError("a comparison needs at least two keys")
    return keys
