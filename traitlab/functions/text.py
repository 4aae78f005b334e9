"""String helpers over columns (STR-1..6, CST-1).

Spark's ``split`` keeps trailing empty fields while the token format was
defined with a splitter that drops them ("a:1:" has two fields, not
three). ``split_dropping_trailing`` strips trailing separators first, which
gives the same field count.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def split_dropping_trailing(text: Column, sep: str) -> Column:
    literal = re.escape(sep)
    return F.split(F.regexp_replace(text, f"(?:{literal})+$", ""), literal)


def before_first(text: Column, sep: str) -> Column:
    """Text before the first ``sep`` (whole text if absent)."""
    return F.substring_index(text, sep, 1)


def leading_int(text: Column, length: int) -> Column:
    """First ``length`` characters as an int; malformed -> null."""
    return F.trim(F.substring(text, 1, length)).try_cast("int")
