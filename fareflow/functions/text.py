"""String, hash and URL expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SEGMENT_DELIMITER = "||"


def split_segments(packed: Column) -> Column:
    """A ``a||b||c`` string as an array; NULL stays NULL."""
    return F.split(F.trim(packed), "[|][|]")      # a regular expression: two literal bars


def count_segments(packed: Column) -> Column:
    """The size of :func:`split_segments`, without cutting the text."""
    text = F.trim(packed)
    bars = F.length(text) - F.length(F.replace(text, F.lit(SEGMENT_DELIMITER), F.lit("")))
    return F.coalesce(F.shiftright(bars, 1) + 1, F.size(F.lit(None).cast("array<string>")))


def clean_segment(element: Column) -> Column:
    """One segment value without stray double quotes and blanks."""
    return F.trim(F.replace(element, F.lit('"'), F.lit("")))


def first_segment(packed: Column) -> Column:
    return clean_segment(F.substring_index(F.trim(packed), SEGMENT_DELIMITER, 1))


def last_segment(packed: Column) -> Column:
    return clean_segment(F.substring_index(F.trim(packed), SEGMENT_DELIMITER, -1))


def concat_text(*parts: Column) -> Column:
    """``a || b``: NULL when any part is NULL."""
    return F.concat(*[p.cast("string") for p in parts])


def position_of(needle: Column, haystack: Column) -> Column:
    """1-based position of the first match, 0 when absent."""
    return F.position(needle, haystack)


def right_text(text: Column, length: Column) -> Column:
    """The last ``length`` characters; empty for a length of 0."""
    return F.right(text, length)


def split_part(text: Column, delimiter: Column, part: int) -> Column:
    return F.split_part(text, delimiter, F.lit(part))


def safe_cast(value: Column, type_name: str) -> Column:
    """The cast value, NULL when it does not parse."""
    return value.try_cast(type_name)


def bool_text(flag: Column) -> Column:
    """``true`` / ``false`` in lower case."""
    return flag.cast("string")


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def md5_text(value: Column) -> Column:
    return F.md5(value.cast("string"))


def surrogate_key(*fields: Column) -> Column:
    """md5 over the fields joined by ``-``; a NULL field counts as an empty string.

    NULLs are replaced before joining because ``concat_ws`` leaves them out.
    """
    return F.md5(F.concat_ws("-", *[F.coalesce(f.cast("string"), F.lit("")) for f in fields]))


def _without(text: Column, *prefixes: str) -> Column:
    for prefix in prefixes:
        text = F.replace(text, F.lit(prefix), F.lit(""))
    return text


def url_host(url: Column) -> Column:
    """Host part, with or without a scheme (``parse_url`` needs one)."""
    rest = _without(url, "android-app://", "http://", "https://")
    return F.split_part(F.split_part(rest, F.lit("/"), F.lit(1)), F.lit("?"), F.lit(1))


def url_path(url: Column) -> Column:
    """Text after the host's slash, without the query string.

    Empty for ``host?query``; a bare host without slash or query is returned as it is.
    """
    rest = _without(url, "http://", "https://")
    slash = F.position(F.lit("/"), rest)
    cut = F.when(slash > 0, slash).otherwise(F.position(F.lit("?"), rest) - 1)
    tail = F.right(rest, F.length(rest) - cut)
    return F.split_part(tail, F.lit("?"), F.lit(1))


def url_parameter(url: Column, name: str) -> Column:
    """Value after the first ``name=``, NULL when absent or empty."""
    after = F.split_part(url, F.lit(f"{name}="), F.lit(2))
    return F.nullif(F.split_part(after, F.lit("&"), F.lit(1)), F.lit(""))
