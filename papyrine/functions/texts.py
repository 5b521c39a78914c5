"""General string functions and the in-band error convention."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a Python `str` pattern treats as \s. Java's \s is ASCII only, so the
# rest is spelled out. Usable in Java and RE2 alike.
SPACE = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"

# The error texts that travel in the data.
ERROR_PREFIX = "Error"
NULL_PATH_ERROR = "Error: PDF path is None"
EXTRACT_ERROR = "Error: Failed to process PDF "
READ_ERROR = "Error processing "


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind (`F.trim` removes spaces only)."""
    return F.regexp_replace(text, rf"\A{SPACE}+|(?<!{SPACE}){SPACE}+\z", "")  # the lookbehind keeps it linear


def is_blank(text: Column) -> Column:
    """True when nothing but whitespace is there; null stays null."""
    return ~text.rlike(SPACE.replace("[", "[^", 1))


def truncate(text: Column, length: int) -> Column:
    """The first `length` code points."""
    return F.substring(text, 1, length)


def is_error(text: Column) -> Column:
    return F.startswith(text, F.lit(ERROR_PREFIX))


def null_path_error() -> Column:
    return F.lit(NULL_PATH_ERROR)


def extract_error(path: Column) -> Column:
    return F.concat(F.lit(EXTRACT_ERROR), path)


def read_error(path: Column, reason: Column) -> Column:
    return F.concat(F.lit(READ_ERROR), path, F.lit(": "), reason)
