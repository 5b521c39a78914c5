"""Path functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Splits a file name at its last dot; dots in front of the name belong to the name.
NAME_PARTS = r"(?s)\A(\.*(?:[^.].*?)?)(\.[^.]*)?\z"


def strip_scheme(path: Column) -> Column:
    return F.regexp_replace(path, r"\Afile:", "")


def percent_decode(path: Column) -> Column:
    """Decode %XX escapes; `+` and malformed escapes stay as they are."""
    protected = F.regexp_replace(F.replace(path, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(protected), path)


def normalize_path(path: Column, always_decode: bool = True) -> Column:
    """Drop `file:` and decode. With `always_decode=False` only paths that had the scheme are decoded."""
    decoded = percent_decode(strip_scheme(path))
    return decoded if always_decode else F.when(F.startswith(path, F.lit("file:")), decoded).otherwise(path)


def rebase_path(path: Column, pattern: str, replacement: str) -> Column:
    """Replace every match of a Java regular expression, as in moving paths to another base folder."""
    return F.regexp_replace(path, pattern, replacement)


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(name: Column) -> Column:
    return F.regexp_extract(name, NAME_PARTS, 1)


def extension(name: Column) -> Column:
    return F.regexp_extract(name, NAME_PARTS, 2)


def numbered_name(name: Column, number: Column) -> Column:
    """`report.pdf`, 2 -> `report_2.pdf`."""
    return F.concat(stem(name), F.lit("_"), number.cast("string"), extension(name))


def has_extension(path: Column, *extensions: str) -> Column:
    """Case-insensitive test for any of the extensions, each with its dot."""
    lowered = F.lower(path)
    found = F.lit(False)
    for one in extensions:
        found = found | F.endswith(lowered, F.lit(one.lower()))
    return found


def subset_folder(subset_id: Column) -> Column:
    return F.concat(F.lit("subset_"), subset_id.cast("string"))


def plain_path(path: Column) -> Column:
    """One spelling for a file's path: local ones begin with a single slash, without a scheme; others stay as they are."""
    return F.regexp_replace(path, r"\A(?:file:)?/+", "/")
