"""Wiki markup -> plain text and links, as a DataFrame job.

One page is one row, so everything a page needs (link offsets, external-link
numbers, section numbers) is computed inside its row with built-in expressions:
the conversion has no shuffle, no window and no Python.

The text passes through an ordered list of rules (name, Column -> Column). While
it does, control characters that XML forbids serve as marks:

    MARK .. MARK              a link and the text it shows (links never nest)
    LINE / PARAGRAPH          a request for one / two newlines
    EXTERNAL                  an external link that still needs its number
    HEADING level LEVEL_END   a heading that still needs its outline number
    NEVER                     the `<` of a hidden tag that nothing closes
    OPEN / CLOSE              a brace of a run of them, while runs are matched

The first rule removes those characters from the input, so they are unambiguous.

Rules are guarded by a cheap byte search (`contains`) and their patterns start with
a literal, so that a page pays only for the markup it has. Repeated groups are
possessive, which the regex engine runs as a loop: a page of many megabytes cannot
exhaust the stack.
"""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from functools import lru_cache, reduce

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import config as C
from ..functions.arrays import bound, running, scan, sum_before
from ..functions.entities import decode_entities

Rule = tuple[str, Callable[[Column], Column]]

MARK = "\x01"
LINE, PARAGRAPH = "\x03", "\x04"
GAP = "\n" + PARAGRAPH
EXTERNAL = "\x05"
HEADING, LEVEL_END = "\x06", "\x07"
REDIRECT = "\x08"
TABLE, ROW, CUT = "\x0e", "\x0f", "\x10"
NEVER = "\x11"
OPEN, CLOSE = "\x12", "\x13"

# Extension tags that are hidden together with their content.
TAG_EXTENSIONS = (
    "categorytree", "ce", "charinsert", "chem", "gallery", "graph", "hiero", "imagemap",
    "indicator", "inputbox", "mapframe", "maplink", "math", "nowiki", "poem", "pre", "ref",
    "references", "score", "section", "source", "syntaxhighlight", "templatedata",
    "templatestyles", "timeline",
)

# Protocols that open an external link.
PROTOCOLS = (
    "http", "https", "ftp", "ftps", "ssh", "sftp", "irc", "ircs", "gopher", "telnet", "nntp",
    "worldwind", "mailto", "news", "svn", "git", "mms", "bitcoin", "magnet", "urn", "geo",
)

# Control characters that XML forbids, one by one: a class of single characters is a
# table look-up for the regex engine, a class of ranges is not.
_ILLEGAL = "[" + "".join(rf"\x{i:02x}" for i in range(32) if i not in (9, 10, 13)) + "]"
_HIDDEN = (
    r"(?is)<(?:!--.*?-->|(" + "|".join(TAG_EXTENSIONS) + r")(?:\s[^<>]*?)?(?:/>|>.*?</\1\s*>))"
)
_BRACES = r"(?:[^{}]++|\{(?!\{)|\}(?!\}))*+"
# Runs of exactly three; what longer runs mean depends on what they enclose.
_PARAMETER = r"(?<!\{)\{\{\{(?!\{)" + _BRACES + r"\}\}\}(?!\})"
_TEMPLATE = r"\{\{" + _BRACES + r"\}\}"
_TABLE_OPEN = r"^[ \t:]*+\{\|"
_TABLE_CLOSE = r"^[ \t]*+\|\}(?!\})"
_ATTRIBUTES = (
    r"(?:(?:[\w:-]++[ \t]*+=[ \t]*+(?:\"[^\"\n]*+\"|'[^'\n]*+'|[^\s|\"'\[\]]++)[ \t]*+)++"
    r"\|(?!\|)[ \t]*+)?"
)
_BRACKETS = r"(?:[^\[\]]++|\[\[[^\[\]]*+\]\]|\[(?!\[)[^\[\]]*+\]|\[(?!\[)|\](?!\]))*+"
_IMAGE = r"\[\[[ _\t]*+(?i:file|image)[ _\t]*+:" + _BRACKETS + r"\]\]"
_TARGET = r"[^\[\]|{}<>\n\x01]++"
_TITLE = r"(?:[^\[\]]++|\[(?!\[)[^\[\]]*+\]|\[(?!\[)|\](?!\]))*+"
# Groups: 1 target, 2 title, 3 target again when there is no title, 4 postfix.
_LINK = (
    r"\[\[(?=(" + _TARGET + r"))(?:" + _TARGET + r"\|(" + _TITLE + r")|(" + _TARGET + r"))\]\]"
    r"([a-z]*+)"
)
# The same links, for those who ask for group 1 only.
_LINK_TARGET = r"\[\[(" + _TARGET + r")(?:\|" + _TITLE + r")?+\]\]"
_CATEGORY = (
    r"\[\[[ _\t]*+(?i:category)[ _\t]*+:[^\[\]|{}<>\n]*+(?:\|" + _TITLE + r")?\]\][a-z]*+"
)
_REDIRECT = r"\A\s*+#(?i:REDIRECT)\s*+:?\s*+\[\[([^\[\]|{}<>\n]++)(?:\|[^\[\]]*+)?\]\]"
_EMPTY_REDIRECT = r"\A\s*+#(?i:REDIRECT)\s*+:?\s*+\[\[\s*+(?:\|[^\[\]]*+)?\]\]"
_URL = r"[^\s\[\]<>\"\x01]++"
_EXTERNAL = (
    r"\[((?i:" + "|".join(PROTOCOLS) + r"):" + _URL + r"|//" + _URL + r")"
    r"[ \t]*+([^\[\]\n]*+(?:\[[^\[\]\n]*+\][^\[\]\n]*+)*+)\]"
)
# Texts in which no rule that hides markup finds anything to change: no tag, brace, colon (of
# images and categories), switch or redirect, no character that is dropped, no broken UTF-8.
_NOTHING_HIDDEN = (
    r"\A(?!\s*+#)(?:[^<{:_" + "".join(rf"\x{i:02x}" for i in range(32) if i not in (9, 10, 13)) + r"\ufffd-\uffff]++|_(?!_))*+\z"
)
_BREAKS = "\n" + LINE + PARAGRAPH + TABLE + ROW


def _has(c: Column, *literals: str) -> Column:
    found = F.contains(c, F.lit(literals[0]))
    for text in literals[1:]:
        found = found | F.contains(c, F.lit(text))
    return found


def _where(found: Column, c: Column, changed: Column) -> Column:
    return F.when(found, changed).otherwise(c)


# --- rules that hide or unfold markup, before links are cut out ------------------


def drop_illegal(c: Column) -> Column:
    """Characters a document may not hold go; a newline goes in front, so that every
    line starts after one."""
    return F.concat(F.lit("\n"), F.regexp_replace(c, _ILLEGAL, ""))


def drop_noncharacters(c: Column) -> Column:
    return _where(_has(c, "￾", "￿"), c, F.regexp_replace(c, "[￾￿]", ""))


# Where a page is no longer than this, looking for closers that never come costs nothing.
_LONG = 1 << 13


def closers(tags: Sequence[str]) -> tuple[tuple[str, str], ...]:
    """Patterns of opener and closer for comments and each tag."""
    openers = ((rf"(?i)<(?={t}(?:\s[^<>]*+)?(?<!/)>)", rf"(?i)</{t}\s*+>") for t in tags)
    return (("<(?=!--)", "-->"), *openers)


def hide_closed(c: Column, pattern: str, kinds: Sequence[tuple[str, str]], to: str = "") -> Column:
    """Replace `pattern`, in time that grows with the page and no faster. Behind the last
    closer of a kind, nothing ends an opener, and each would be followed to the end of the
    page; there, NEVER stands for its `<` meanwhile."""
    table = F.array(*[F.struct(F.lit(o).alias("o"), F.lit(x).alias("x")) for o, x in kinds])

    def mark(acc: Column, kind: Column) -> Column:
        tail = F.element_at(F.split(acc, kind["x"], F.lit(-1)), -1)
        head = F.substring(acc, F.lit(1), F.length(acc) - F.length(tail))
        return F.concat(head, F.regexp_replace(tail, kind["o"], F.lit(NEVER)))

    marked = F.regexp_replace(F.aggregate(table, c, mark), pattern, to)
    return F.when(F.length(c) <= _LONG, F.regexp_replace(c, pattern, to)).otherwise(F.replace(marked, F.lit(NEVER), F.lit("<")))


def hide_extensions(c: Column) -> Column:
    """Comments and extension tags go with their content."""
    return _where(_has(c, "<"), c, hide_closed(c, _HIDDEN, closers(TAG_EXTENSIONS)))


def hide_parameters(c: Column) -> Column:
    return _where(_has(c, "{{{"), c, F.regexp_replace(c, _PARAMETER, ""))


def hide_templates(c: Column) -> Column:
    """Innermost templates with their arguments."""
    return _where(_has(c, "{{"), c, F.regexp_replace(c, _TEMPLATE, ""))


# What braces can be: a run that opens, one that closes, or text.
_BRACE_TOKEN = r"(?:\{\{++|\}\}++|[^{}]++|\{|\})"
_TOKENS_AT_ONCE = 128
# More braces than a text can have, and still a number that counts can be taken from.
_NEVER_LOWER = 2**30


# Hills of braces that one fold takes down, and folds that are enough for any text.
_HILLS, _FOLDS = 256, 4
# Up to the next brace that opens behind one that closes; so many of them.
_HILL = f"[^{CLOSE}]*+[^{OPEN}]*+"
_BLOCK_OF_HILLS = rf"(?:[^{CLOSE}]*+{CLOSE}[^{OPEN}]*+){{1,{_HILLS}}}+|[^{CLOSE}]++"


def _until(text: Column, mark: str, count: Column) -> Column:
    return F.call_function("substring_index", text, F.lit(mark), count)


def _how_many(text: Column, mark: str) -> Column:
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(mark), F.lit("")))


def _take_down(block: Column) -> Column:
    """Text without the braces that match in it, and what they enclose. Braces come in hills:
    first some that open, then some that close, of which the fewer all match. What is left has
    no brace that opens before one that closes."""

    def hill(text: Column) -> Column:
        up = F.substring_index(text, CLOSE, 1)
        down = F.substring(text, F.length(up) + 1, F.length(text))
        return F.struct(up.alias("up"), down.alias("down"), _how_many(up, OPEN).alias("opened"), _how_many(down, CLOSE).alias("closed"))

    def step(acc: Column, h: Column) -> Column:
        open_ = acc["open"] + h["opened"] - h["closed"]
        kept = _until(F.concat(acc["text"], h["up"]), OPEN, F.greatest(open_, F.lit(0)) + 1)
        return F.struct(F.concat(kept, _until(h["down"], CLOSE, F.least(open_, F.lit(0)) - 1)).alias("text"), F.greatest(open_, F.lit(0)).alias("open"))

    hills = F.transform(F.regexp_extract_all(block, F.lit(_HILL), F.lit(0)), hill)
    return F.aggregate(hills, F.struct(F.lit("").alias("text"), F.lit(0).alias("open")), step, lambda acc: acc["text"])


def match_braces(c: Column) -> Column:
    """The text without templates and parameters, nested to any depth.

    Braces of runs match one by one. Blocks of hills are taken down alone, so that the work grows
    with the text; what is left of a block is half a hill on either side, so each fold leaves a
    hill or less of each block.
    """
    marked = c
    for brace, mark in (("{", OPEN), ("}", CLOSE)):
        marked = F.replace(marked, F.lit(brace * 2), F.lit(mark * 2))
        marked = F.replace(marked, F.lit(mark + brace), F.lit(mark * 2))

    def step(text: Column, _: Column) -> Column:
        blocks = F.regexp_extract_all(text, F.lit(_BLOCK_OF_HILLS), F.lit(0))
        matches = _has(text, CLOSE) & F.rlike(text, F.lit(f"{OPEN}[^{OPEN}{CLOSE}]*+{CLOSE}"))
        return _where(matches, text, F.array_join(F.transform(blocks, _take_down), ""))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_FOLDS)), marked, step, lambda text: F.translate(text, OPEN + CLOSE, "{}"))


def count_braces(c: Column) -> Column:
    """The text without templates and parameters, nested to any depth, in one pass.

    A run of closing braces ends what the last open braces began, so a count of open braces
    stands for a stack of them: it rises by a run that opens, falls by one that closes, and
    what it cannot fall by is left over. A token is enclosed if the count falls below its own
    somewhere behind it. The count, the least before and the least behind are running sums and
    minima, taken in blocks of tokens. Braces that match nothing stay.
    """

    def change(token: Column) -> Column:
        n = F.length(token)
        return F.when(F.startswith(token, F.lit("{{")), n).when(F.startswith(token, F.lit("}}")), -n).otherwise(0)

    def block(text: Column) -> Column:
        def summed(tokens: Column) -> Column:
            return bound(
                scan(F.transform(tokens, change), F.lit(0), lambda a, x: a + x),
                lambda sums: F.struct(
                    tokens.alias("tokens"), sums.alias("sums"), F.element_at(sums, -1).alias("total"), F.array_min(sums).alias("least")
                ),
            )

        return bound(F.regexp_extract_all(text, F.lit(_BRACE_TOKEN), F.lit(0)), summed)

    def joined(blocks: Column) -> Column:
        starts = F.concat(F.array(F.lit(0)), running(F.transform(blocks, lambda b: b["total"]), F.lit(0), lambda a, x: a + x))
        return bound(starts, lambda s: bound(F.transform(blocks, lambda b, i: F.get(s, i) + b["least"]), lambda least: texts(blocks, s, least)))

    def texts(blocks: Column, starts: Column, least: Column) -> Column:
        before = F.concat(F.array(F.lit(0)), running(least, F.lit(0), F.least))
        behind = F.reverse(running(F.reverse(least), F.lit(_NEVER_LOWER), F.least))

        def of(both: Column) -> Column:
            def text(b: Column, i: Column) -> Column:
                start = F.get(starts, i)
                last = F.coalesce(F.get(both["behind"], i + 1), F.lit(_NEVER_LOWER))
                sums = F.transform(b["sums"], lambda x: x + start)
                return bound(sums, lambda x: kept(b["tokens"], x, start, F.get(both["before"], i), last))

            return F.array_join(F.transform(blocks, text), "")

        return bound(F.struct(before.alias("before"), behind.alias("behind")), of)

    def kept(tokens: Column, sums: Column, start: Column, least_before: Column, least_behind: Column) -> Column:
        before = F.concat(F.array(least_before), scan(sums, least_before, F.least))
        behind = F.concat(F.reverse(scan(F.reverse(sums), least_behind, F.least)), F.array(least_behind))

        def token(t: Column, i: Column, low: Column) -> Column:
            count, floor, behind = F.get(sums, i), F.get(low["before"], i + 1), F.get(low["behind"], i + 1)
            unmatched = F.least(behind - F.when(i == 0, start).otherwise(F.get(sums, i - 1)), F.length(t))
            return (
                F.when(F.startswith(t, F.lit("{{")), F.repeat(F.lit("{"), F.greatest(unmatched, F.lit(0))))
                .when(F.startswith(t, F.lit("}}")), F.repeat(F.lit("}"), F.get(low["before"], i) - floor))
                .when((count > floor) & (behind < count), F.lit(""))
                .otherwise(t)
            )

        return bound(
            F.struct(before.alias("before"), behind.alias("behind")),
            lambda low: F.array_join(F.transform(tokens, lambda t, i: token(t, i, low)), ""),
        )

    chunks = F.regexp_extract_all(c, F.lit(f"{_BRACE_TOKEN}{{1,{_TOKENS_AT_ONCE}}}+"), F.lit(0))
    return bound(F.transform(chunks, block), joined)


def hide_nested_parameters(c: Column) -> Column:
    """Where parameters nest, or runs of braces touch: all parameters and templates."""
    return _where(_has(c, "{{{"), c, match_braces(c))


def hide_deep_templates(c: Column) -> Column:
    """What nests deeper than the passes before; unbalanced braces stay as text."""
    return _where(_has(c, "{{") & F.rlike(c, F.lit(_TEMPLATE)), c, match_braces(c))


def hide_switches(c: Column) -> Column:
    return _where(_has(c, "__"), c, F.regexp_replace(c, r"__[A-Z]++__", ""))


def open_elements(c: Column) -> Column:
    """XML elements keep their body; `br` is a new line."""
    opened = F.regexp_replace(c, r"<(?i:br)\s*+/?>", LINE)
    return _where(_has(c, "<"), c, F.regexp_replace(opened, r"</?[a-zA-Z][^<>]*+>", ""))


def _table_lines(c: Column) -> Column:
    start = r"(?:^|(?<=[\x0e\x0f]))[ \t]*+"
    for pattern, to in (
        (r"(?dm)" + _TABLE_OPEN + r"[^\n]*+\n?", TABLE),
        (r"(?:\A|\n)[ \t]*+\|\}\z", LINE),
        (r"(?dm)\n?" + start + r"\|-[^\n]*+\n?", ROW),
        (r"(?dm)\n?" + start + r"\|\+[ \t]*+" + _ATTRIBUTES + r"([^\n]*+)\n?", ROW + "$1" + ROW),
        (r"(?dm)(" + start + r"!|\G(?!^))([^\n!]*+(?:!(?!!)[^\n!]*+)*+)!!", "$1$2||"),
        (r"([\x0e\x0f])[ \t]*+[|!][ \t]*+" + _ATTRIBUTES, "$1"),
        (r"\A\n[ \t]*+[|!](?!\|)[ \t]*+" + _ATTRIBUTES, LINE),
        (r"[ \t]*+\n[ \t]*+[|!](?!\|)[ \t]*+" + _ATTRIBUTES, " "),
        (r"[ \t]*+\n?[ \t]*+\|\|[ \t]*+" + _ATTRIBUTES, " "),
    ):
        c = F.regexp_replace(c, pattern, to)
    return c


def open_tables(c: Column) -> Column:
    """Rows become lines, cells are joined by one space, markup and attributes go.

    The text is cut at the table brackets and the depth is carried along, so that
    pipes outside of tables are left alone and tables may nest.
    """
    cut = F.regexp_replace(c, r"(?dm)(" + _TABLE_OPEN + r")", CUT + "$1")
    cut = F.regexp_replace(cut, r"(?dm)(" + _TABLE_CLOSE + r")", "$1" + CUT)
    steps = F.transform(
        F.split(cut, CUT),
        lambda s: F.struct(
            s.alias("text"),
            F.rlike(s, F.lit(r"\A[ \t:]*+\{\|")).cast("int").alias("opens"),
            F.rlike(s, F.lit(r"(?dm)^[ \t]*+\|\}\z")).cast("int").alias("closes"),
        ),
    )
    start = F.struct(F.lit(0).alias("depth"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        inside = acc["depth"] + s["opens"]
        return F.struct(
            F.greatest(inside - s["closes"], F.lit(0)).alias("depth"),
            F.concat(
                acc["out"],
                F.array(F.when(inside > 0, _table_lines(s["text"])).otherwise(s["text"])),
            ).alias("out"),
        )

    opened = F.array_join(F.aggregate(steps, start, step, lambda acc: acc["out"]), "")
    return _where(_has(c, "{|"), c, opened)


def hide_images(c: Column) -> Column:
    return _where(_has(c, "[["), c, F.regexp_replace(c, _IMAGE, ""))


def _may_redirect(c: Column) -> Column:
    return F.startswith(F.ltrim(c, F.lit(" \t\r\n\x0b\x0c")), F.lit("#"))


def name_redirect(c: Column) -> Column:
    named = F.regexp_replace(c, _REDIRECT, f"REDIRECT: [[{REDIRECT}$1]]{REDIRECT}")
    return _where(_may_redirect(c), c, named)


def drop_redirect_mark(c: Column) -> Column:
    return _where(_has(c, REDIRECT), c, F.regexp_replace(c, REDIRECT, ""))


def hide_categories(c: Column) -> Column:
    return _where(_has(c, "[["), c, F.regexp_replace(c, _CATEGORY, ""))


# --- rules that shape the text around the marked links ---------------------------


def mark_external(c: Column) -> Column:
    return _where(_has(c, "["), c, F.regexp_replace(c, _EXTERNAL, EXTERNAL + "$2 ($1)"))


def drop_emphasis(c: Column) -> Column:
    """Runs of 2, 3 and 5 apostrophes are markers; what a run has in excess is text."""
    none = F.lit("")
    usual = F.replace(F.replace(c, F.lit("'" * 3), none), F.lit("'" * 2), none)
    excess = F.regexp_replace(c, r"('*)'{5}|(')'{3}(?!')|'{2,3}", "$1$2")
    return F.when(_has(c, "'" * 4), excess).when(_has(c, "''"), usual).otherwise(c)


def mark_headings(c: Column) -> Column:
    marked = F.regexp_replace(
        c,
        r"(?d)\n(={1,6})[ \t]*+([^\n]+?)[ \t]*\1[ \t]*(?=\n|\z)",
        GAP + HEADING + "$1" + LEVEL_END + "$2" + GAP,
    )
    return _where(_has(c, "\n="), c, marked)


def mark_rules(c: Column) -> Column:
    return _where(_has(c, "\n----"), c, F.regexp_replace(c, r"\n-{4,}+", GAP))


def mark_blocks(c: Column) -> Column:
    """A paragraph ends where a list or a table starts."""
    marked = F.regexp_replace(
        c,
        r"\n(?![*#;:\x03\x04\x0e])(?=[ \t]*+\S)([^\n]++)\n(?=[*#\x0e])",
        "\n$1" + GAP + "\n",
    )
    return _where(_has(c, "\n*", "\n#", TABLE), c, marked)


def mark_blank_lines(c: Column) -> Column:
    """A paragraph ends at a blank line."""
    return _where(_has(c, "\n\n", "\n ", "\n\t"), c, F.regexp_replace(c, r"\n(?:[ \t]*+\n)++", GAP + "\n"))


def mark_items(c: Column) -> Column:
    return _where(_has(c, "\n*", "\n#"), c, F.regexp_replace(c, r"\n[*#]++[ \t]*+", LINE))


def trim_newlines(c: Column) -> Column:
    """No newline is written at either end of the text."""
    return F.btrim(c, F.lit(_BREAKS))


def write_paragraphs(c: Column) -> Column:
    """Adjacent requests give the largest of them: first those of two newlines."""
    joined = F.regexp_replace(F.regexp_replace(c, rf"\x04[{_BREAKS}]*+", PARAGRAPH), r"[\n\x03\x0e\x0f]++\x04", "\n\n")
    # Where a newline stands before each of them, as the rules write them, one search does both.
    usual = ~_has(F.replace(c, F.lit(GAP), F.lit("")), PARAGRAPH)
    at_once = F.regexp_replace(c, rf"[\n\x03\x0e\x0f]++\x04[{_BREAKS}]*+", "\n\n")
    return F.when(~_has(c, PARAGRAPH), c).when(usual, at_once).otherwise(joined)


def write_lines(c: Column) -> Column:
    joined = F.regexp_replace(c, r"\n*+[\x03\x0e\x0f][\n\x03\x0e\x0f]*+", "\n")
    return _where(_has(c, LINE, TABLE, ROW), c, joined)


def number_external(c: Column) -> Column:
    """`[n] ` before each external link, n from 1 on every page."""
    numbered = F.transform(
        F.split(c, EXTERNAL),
        lambda s, i: F.when(i == 0, s).otherwise(
            F.concat(F.lit("["), i.cast("string"), F.lit("] "), s)
        ),
    )
    return _where(_has(c, EXTERNAL), c, F.array_join(numbered, ""))


def section_labels(levels: Column) -> Column:
    """Outline labels (`1.2. `) for the heading levels of one page, in order.

    A heading restarts everything below its level and continues the count of its
    own level when a heading of that level is open; skipped levels count as 1, and
    the first level is never written. Of two headings only a second one of the same
    level counts anything but 1, which takes no fold to tell.
    """

    def of_two(level: Column, i: Column) -> Column:
        last = F.when((i == 1) & (F.get(levels, F.lit(0)) == level), F.lit("2. ")).otherwise(F.lit("1. "))
        return F.when(level == 1, F.lit("")).otherwise(F.concat(F.repeat(F.lit("1."), level - 2), last))

    return F.when(F.size(levels) <= 2, F.transform(levels, of_two)).otherwise(count_sections(levels))


def count_sections(levels: Column) -> Column:
    """`section_labels` of any number of headings, by one fold over them."""
    shown = range(2, 7)
    none = [F.lit(0).alias(f"c{k}") for k in shown]
    start = F.struct(
        *none, F.lit(0).alias("open"), F.array().cast("array<string>").alias("labels")
    )

    def count(acc: Column, level: Column, k: int) -> Column:
        """Count of level k once a heading of `level` is seen; `open` has a bit per level."""
        again = acc["open"].bitwiseAND(2**k) > 0
        present = F.greatest(acc[f"c{k}"], F.lit(1))
        return (
            F.when(level < k, 0)
            .when((level == k) & again, acc[f"c{k}"] + 1)
            .otherwise(present)
        )

    def step(acc: Column, level: Column) -> Column:
        counts = {k: count(acc, level, k) for k in shown}
        label = F.concat_ws(".", *[F.when(level >= k, n.cast("string")) for k, n in counts.items()])
        bit = F.element_at(F.array(*[F.lit(2**k) for k in range(1, 7)]), level)
        return F.struct(
            *[n.alias(f"c{k}") for k, n in counts.items()],
            acc["open"].bitwiseAND(bit - 1).bitwiseOR(bit).alias("open"),
            F.concat(
                acc["labels"],
                F.array(F.when(level > 1, F.concat(label, F.lit(". "))).otherwise(F.lit(""))),
            ).alias("labels"),
        )

    return F.aggregate(levels, start, step, lambda acc: acc["labels"])


def number_sections(c: Column) -> Column:
    """The outline label in front of each heading; up to two of them, which is usual, without a
    loop: see `section_labels`."""

    def numbered(piece: Column, before: Column | None = None) -> Column:
        level = F.instr(piece, LEVEL_END) - 1
        last = F.lit("1. ") if before is None else F.when(level == F.instr(before, LEVEL_END) - 1, F.lit("2. ")).otherwise(F.lit("1. "))
        label = F.when(level > 1, F.concat(F.repeat(F.lit("1."), level - 2), last)).otherwise(F.lit(""))
        return F.concat(label, F.substr(piece, level + 2))

    def few(pieces: Column) -> Column:
        text, first, second = (F.get(pieces, F.lit(i)) for i in range(3))
        one = F.concat(text, numbered(first))
        return F.when(F.size(pieces) == 2, one).when(F.size(pieces) == 3, F.concat(one, numbered(second, first))).otherwise(number_many_sections(c))

    return _where(_has(c, HEADING), c, bound(F.split(c, HEADING), few))


def number_many_sections(c: Column) -> Column:
    """`number_sections` of any number of headings."""
    pieces = F.split(c, HEADING)
    headed = F.slice(pieces, F.lit(2), F.size(pieces))
    levels = F.transform(headed, lambda s: F.length(F.substring_index(s, LEVEL_END, 1)))
    numbered = F.zip_with(
        headed,
        section_labels(levels),
        lambda s, label: F.concat(
            label, F.substring(s, F.instr(s, LEVEL_END) + 1, F.length(s))
        ),
    )
    return F.concat(F.element_at(pieces, 1), F.array_join(numbered, ""))


HIDING_RULES: tuple[Rule, ...] = (
    ("illegal_characters", drop_illegal),
    ("noncharacters", drop_noncharacters),
    ("comments_and_extensions", hide_extensions),
    ("parameters", hide_parameters),
    ("nested_parameters", hide_nested_parameters),
    ("templates", hide_templates),
    ("outer_templates", hide_templates),
    ("deep_templates", hide_deep_templates),
    ("page_switches", hide_switches),
    ("elements", open_elements),
    ("tables", open_tables),
    ("images", hide_images),
    ("redirect", name_redirect),
    ("categories", hide_categories),
)

NEWLINE_RULES: tuple[Rule, ...] = (
    ("outer_newlines", trim_newlines),
    ("paragraph_newlines", write_paragraphs),
    ("line_newlines", write_lines),
)

SHAPING_RULES: tuple[Rule, ...] = (
    ("external_links", mark_external),
    ("emphasis", drop_emphasis),
    ("headings", mark_headings),
    ("rules", mark_rules),
    ("blocks", mark_blocks),
    ("blank_lines", mark_blank_lines),
    ("list_items", mark_items),
    *NEWLINE_RULES,
    ("external_numbers", number_external),
    ("section_numbers", number_sections),
    ("entities", decode_entities),
)

DEFAULT_RULES: dict[str, tuple[Rule, ...]] = {"hide": HIDING_RULES, "shape": SHAPING_RULES}


def keep_apart(df: DataFrame, **columns: Column) -> DataFrame:
    """Add expensive columns so that a later filter on them is not pushed below and
    evaluated a second time (a generator stops the push-down)."""
    packed = F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))
    return df.select("*", F.inline_outer(packed))


@lru_cache(maxsize=1024)
def _build(gateway: object, make: Callable[..., Column], *args: str) -> Column:
    """Columns are plain descriptions: build each once per JVM, it is thousands of
    calls otherwise each time a conversion is planned."""
    return make(*(F.col(a) for a in args))


def built(make: Callable[..., Column], *args: str) -> Column:
    return _build(SparkContext._gateway, make, *args)


def apply_rules(df: DataFrame, column: str, rules: Sequence[Rule]) -> DataFrame:
    """One projection per rule: a rule may mention its input several times, and the
    input must not be evaluated again each time."""
    for _, rule in rules:
        df = df.withColumn(column, built(rule, column))
    return df


def hide_markup(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """`_markup`: the wikitext after the rules that hide markup. One search tells most texts that
    hold none for them; those are null while the rules pass, which costs next to nothing."""
    text = F.col("wikitext")
    if rules is not HIDING_RULES:
        return apply_rules(df.withColumn("_markup", text), "_markup", rules)
    df = df.withColumn("_markup", F.when(~F.rlike(text, F.lit(_NOTHING_HIDDEN)), text))
    df = apply_rules(df, "_markup", rules)
    return df.withColumn("_markup", F.coalesce("_markup", F.concat(F.lit("\n"), text)))


def _cut(marked: Column) -> Column:
    return F.split(marked, MARK)


# The starts of up to so many pieces are added up without a loop.
_FEW_PIECES = 9


def _piece_starts(pieces: Column) -> Column:
    """The lengths before each piece; one more entry holds the length of all."""
    lengths = [F.coalesce(F.length(F.get(pieces, F.lit(i))), F.lit(0)) for i in range(_FEW_PIECES)]
    sums = F.array(*[reduce(operator.add, lengths[:i], F.lit(0)) for i in range(_FEW_PIECES + 1)])
    n = F.size(pieces)
    return F.when(n.between(0, _FEW_PIECES), F.slice(sums, F.lit(1), n + 1)).otherwise(sum_before(pieces, F.length))


def _in_order(links: Column) -> Column:
    """Internal links before the redirect, which can only stand at the start."""
    redirect_first = F.get(links, F.lit(0))["kind"] == C.KIND_REDIRECT
    turned = F.concat(F.slice(links, F.lit(2), F.size(links)), F.slice(links, 1, 1))
    return F.when(redirect_first, turned).otherwise(links)


def _own_links(df: DataFrame, cfg: C.ImportConfig) -> DataFrame:
    if not cfg.drop_self_anchors:
        return df
    return df.withColumn("links", F.filter("links", lambda k: ~F.startswith(k["target"], F.lit("#"))))


def _kind(target: Column) -> Column:
    return F.when(F.startswith(target, F.lit(REDIRECT)), F.lit(C.KIND_REDIRECT)).otherwise(F.lit(C.KIND_LINK))


def _bare_links(targets: Column) -> Column:
    nothing = [F.lit(None).cast(kind).alias(c) for c, kind in (("surface", "string"), ("start", "int"), ("end", "int"))]
    return F.transform(targets, lambda t: F.struct(_kind(t).alias("kind"), F.ltrim(t, F.lit(REDIRECT)).alias("target"), *nothing))


def _link_structs(targets: Column, pieces: Column, starts: Column) -> Column:
    def link(target: Column, i: Column) -> Column:
        at = i * 2 + 1
        return F.struct(
            _kind(target).alias("kind"),
            F.ltrim(target, F.lit(REDIRECT)).alias("target"),
            F.get(pieces, at).alias("surface"),
            F.get(starts, at).alias("start"),
            F.get(starts, at + 1).alias("end"),
        )

    return F.transform(targets, link)


def links_of_marked(df: DataFrame, marked: str, targets: str) -> DataFrame:
    """Turn marked text plus the raw targets into `text` and `links`.

    Cutting at the marks gives text, link, text, link, ..., text; the lengths
    before a piece add up to its offset. Both arrays are used more than once below,
    which keeps the optimizer from moving them into the loop over the targets.
    """
    df = df.withColumn("_pieces", built(_cut, marked))
    df = df.withColumn("_starts", built(_piece_starts, "_pieces"))
    return (
        df.withColumn("text", F.array_join("_pieces", ""))
        .withColumn("links", built(_link_structs, targets, "_pieces", "_starts"))
        .drop("_pieces", "_starts")
    )


def residue(text: Column) -> Column:
    """How many brackets and definition-list lines no rule understood."""
    left = F.regexp_count(text, F.lit(r"\{\{|\}\}|\[\[|\]\]|\n[;:]"))
    first = F.when(F.startswith(text, F.lit(";")) | F.startswith(text, F.lit(":")), 1).otherwise(0)
    return first + F.when(_has(text, "{{", "}}", "[[", "]]", "\n;", "\n:"), left).otherwise(0)


# What can be left in a text, with the name of its kind.
RESIDUE_KINDS = {
    "{{": "template_open", "}}": "template_close", "[[": "link_open", "]]": "link_close", ";": "definition_term", ":": "definition",
}
_RESIDUE = r"\{\{|\}\}|\[\[|\]\]|(?<![^\n])[;:]"


def residue_tokens(text: Column) -> Column:
    """What no rule understood, as array<struct<kind, start>> in the order of the text: as
    many as `residue` counts."""
    kinds = F.create_map(*[F.lit(x) for pair in RESIDUE_KINDS.items() for x in pair])
    tokens = F.regexp_extract_all(text, F.lit(_RESIDUE), F.lit(0))
    gaps = F.split(text, F.lit(_RESIDUE), F.lit(-1))

    def placed(found: Column) -> Column:
        before = sum_before(F.zip_with(found, F.slice(gaps, F.lit(1), F.size(found)), lambda t, g: F.length(t) + F.length(g)))
        return bound(
            F.struct(before.alias("before"), gaps.alias("gaps")),
            lambda z: F.transform(
                found, lambda t, i: F.struct(F.element_at(kinds, t).alias("kind"), (F.get(z["before"], i) + F.length(F.get(z["gaps"], i))).alias("start"))
            ),
        )

    return bound(tokens, placed)


def empty_redirect(wikitext: Column) -> Column:
    """True for a redirect that names no target."""
    return _may_redirect(wikitext) & F.rlike(wikitext, F.lit(_EMPTY_REDIRECT))


def convert_markup(
    pages: DataFrame,
    rules: dict[str, Sequence[Rule]] | None = None,
    cfg: C.ImportConfig = C.DEFAULT_CONFIG,
    texts: bool = True,
) -> DataFrame:
    """Add `text`, `links` and `residue` to pages that have a `wikitext` column.

    links: array<struct<kind, target, surface, start, end>>, internal links first,
    then redirects, each in document order. Offsets count characters of `text`.
    residue: markup that no rule understood; it is kept in the text.
    Without `texts`, for those who only ask what links to what, links have neither surface nor
    offsets, and there is no `text` and no `residue`: the rules that shape texts are left out.
    """
    rules = {**DEFAULT_RULES, **(rules or {})}
    df = hide_markup(pages, rules["hide"])
    df = df.withColumn("_targets", F.regexp_extract_all("_markup", F.lit(_LINK_TARGET), 1))
    if not texts:
        df = _own_links(df.withColumn("links", _bare_links(F.col("_targets"))).drop("_markup", "_targets"), cfg)
        return keep_apart(df.withColumnRenamed("links", "_links"), links=built(_in_order, "_links")).drop("_links")
    df = df.withColumn("_markup", F.regexp_replace("_markup", _LINK, f"{MARK}$2$3$4{MARK}"))
    df = df.withColumn("_markup", built(drop_redirect_mark, "_markup"))
    df = apply_rules(df, "_markup", rules["shape"])
    df = _own_links(links_of_marked(df, "_markup", "_targets").drop("_markup", "_targets"), cfg)
    text = F.when(F.length("text") > 0, F.col("text")).otherwise(F.col("wikitext"))
    converted = df.withColumn("links", built(_in_order, "links")).withColumn("text", text)
    packed = F.array(F.struct("text", "links"))
    kept = [c for c in converted.columns if c not in ("text", "links")]
    return converted.select(*kept, F.inline_outer(packed)).withColumn(
        "residue", built(residue, "text")
    )
