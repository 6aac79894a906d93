"""Scalar text helpers, all Column -> Column and all evaluated inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the separator between table name and row key in a sink key.
KEY_SEPARATOR = "\u001f"


def java_trim(c: Column) -> Column:
    """Drop every character up to U+0020 from both ends (`trim` drops spaces only)."""
    return F.btrim(c, F.lit("".join(map(chr, range(0x21)))))


def unescape_newlines(c: Column) -> Column:
    """Turn the two characters backslash + n into a newline."""
    return F.replace(c, F.lit("\\n"), F.lit("\n"))


def strip_fragment(c: Column) -> Column:
    """Cut a link target at `#`, unless the target starts with it."""
    return F.when(F.instr(c, "#") > 1, F.substring_index(c, "#", 1)).otherwise(c)


def base64_utf8(c: Column) -> Column:
    """Base64 of the UTF-8 bytes on one line (Spark wraps at 76 characters)."""
    return F.regexp_replace(F.base64(F.encode(c, "UTF-8")), "\r\n", "")


def iso_timestamp(c: Column) -> Column:
    """Read `yyyy-MM-ddTHH:mm:ss`, ignore what follows; anything else is null."""
    return F.try_to_timestamp(F.substring(c, 1, 19), F.lit("yyyy-MM-dd'T'HH:mm:ss"))


def empty_if_null(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def xml_escape(c: Column) -> Column:
    escaped = F.replace(c, F.lit("&"), F.lit("&amp;"))
    escaped = F.replace(escaped, F.lit("<"), F.lit("&lt;"))
    escaped = F.replace(escaped, F.lit(">"), F.lit("&gt;"))
    needed = F.contains(c, F.lit("&")) | F.contains(c, F.lit("<")) | F.contains(c, F.lit(">"))
    return F.when(needed, escaped).otherwise(c)
