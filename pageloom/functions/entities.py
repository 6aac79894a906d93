"""Character references: `&name;`, `&#65;`, `&#x41;` -> characters."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leading zeros mean nothing; a number with more digits than these is no character.
_REFERENCE = r"^(#0*+[0-9]{0,8}|#[xX]0*+[0-9a-fA-F]{0,7}|[A-Za-z][A-Za-z0-9]*+);"


def named_entity(name: Column) -> Column:
    """Character of a named entity of HTML 4 (plus `apos`), null when unknown."""
    table = {"apos": ord("'"), **name2codepoint}
    # One literal that the optimizer folds into a map.
    listed = "\x1e".join(f"{k}\x1f{chr(v)}" for k, v in table.items())
    return F.element_at(F.str_to_map(F.lit(listed), F.lit("\x1e"), F.lit("\x1f")), name)


def code_point(cp: Column) -> Column:
    """Character of a code point; null for what XML does not allow in a document."""
    legal = (
        cp.isin(9, 10, 13)
        | cp.between(0x20, 0xD7FF)
        | cp.between(0xE000, 0xFFFD)
        | cp.between(0x10000, 0x10FFFF)
    )
    return F.when(legal, F.decode(F.unhex(F.lpad(F.hex(cp), 8, "0")), "UTF-32"))


def _resolve(name: Column) -> Column:
    digits = F.when(
        F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.regexp_replace(name, "^#[xX]0*+", ""), 16, 10)
    ).otherwise(F.regexp_replace(name, "^#0*+", ""))
    return F.when(F.startswith(name, F.lit("#")), code_point(digits.try_cast("int"))).otherwise(
        named_entity(name)
    )


def decode_entities(text: Column) -> Column:
    """Replace every known reference; an unknown one stays as it was written."""
    # Cut at each ampersand; a reference can only stand at the start of a piece.
    named = F.transform(
        F.split(text, "&"),
        lambda piece, i: F.struct(
            piece.alias("piece"),
            F.when(i > 0, F.regexp_extract(piece, _REFERENCE, 1)).alias("name"),
        ),
    )
    decoded = F.transform(
        named,
        lambda p: F.when(p["name"].isNull(), p["piece"])
        .when(p["name"] == "", F.concat(F.lit("&"), p["piece"]))
        .otherwise(
            F.concat(
                F.coalesce(_resolve(p["name"]), F.concat(F.lit("&"), p["name"], F.lit(";"))),
                F.substring(p["piece"], F.length(p["name"]) + 2, F.length(p["piece"])),
            )
        ),
    )
    return F.when(F.contains(text, F.lit("&")), F.array_join(decoded, "")).otherwise(text)
