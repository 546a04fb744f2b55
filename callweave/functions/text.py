"""Text functions on columns; all of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ELLIPSIS = "…"


def escape(text: Column, limit: int = 0) -> Column:
    """Cut to `limit` characters and an ellipsis if a limit is given, then escape backslash, quote, LF, CR and tab."""
    cut = F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit(ELLIPSIS))).otherwise(text) if limit > 0 else text
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        cut = F.replace(cut, F.lit(plain), F.lit(escaped))
    return cut


def strip_line_comment(line: Column) -> Column:
    """Everything before the first //, also where that stands inside a string."""
    return F.substring_index(line, "//", 1)


def collapse_spaces(text: Column) -> Column:
    """Runs of white space as one space, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def strip_extension(name: Column) -> Column:
    """A file name up to its last dot."""
    return F.regexp_replace(name, r"\.[^.]*$", "")


def line_at(text: Column, offset: Column) -> Column:
    """The 1-based line of a 0-based character offset."""
    before = F.left(text, offset)
    return F.length(before) - F.length(F.replace(before, F.lit("\n"), F.lit(""))) + 1


def one_line(text: Column) -> Column:
    """Null as empty, line ends escaped."""
    return F.replace(F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))


def preview(text: Column, limit: int = 300) -> Column:
    """At most `limit` characters and an ellipsis on one line; null reads `null`."""
    cut = F.when(F.length(text) > limit, F.concat(F.left(text, F.lit(limit)), F.lit(ELLIPSIS))).otherwise(text)
    return F.coalesce(F.replace(F.replace(cut, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r")), F.lit("null"))


def argument_list(values: Column) -> Column:
    """An array as [a, b], nulls spelled out."""
    return F.concat(F.lit("["), F.array_join(values, ", ", "null"), F.lit("]"))


def char_count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def file_name(prefix: str, shard: Column, rotation: Column, gzip: bool = False) -> Column:
    """prefix, the shard from 1 in four digits, the rotation in five if there is one, and the suffix."""
    base = F.format_string("%s%04d", F.lit(prefix), shard.cast("int") + 1)
    named = F.when(rotation > 0, F.format_string("%s-%05d", base, rotation.cast("int"))).otherwise(base)
    return F.concat(named, F.lit(".btm.gz" if gzip else ".btm"))
