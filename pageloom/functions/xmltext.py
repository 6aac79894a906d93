"""What an XML element says, where the typed reader keeps only part of it.

Spark's XML reader keeps one text node of an element. Pages whose text holds comments, CDATA
sections, processing instructions or child elements are rare; theirs is read from the raw
element with the expressions below. All of them take well-formed XML.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import sum_before
from .entities import decode_entities
from .strings import xml_escape

_MARKERS = r"<!--|-->|<!\[CDATA\[|\]\]>|<\?|\?>|</?page(?=[\s/>])"
_CONTENT, _COMMENT, _CDATA, _INSTRUCTION = range(4)
_SECTION = r"(?s)<!\[CDATA\[.*?\]\]>|<!--.*?-->|<\?.*?\?>"
_ATTRIBUTES = r"""(?:\s++[^\s=<>/]++\s*+=\s*+(?:"[^"]*+"|'[^']*+'))*+\s*+"""
_TEXT = rf"(?s)<text{_ATTRIBUTES}>(.*?)</text\s*+>"
_TAG = r"""</?[^\s<>/]++(?:[^<>"']++|"[^"]*+"|'[^']*+')*+>"""

# Characters that XML forbids or rewrites, one by one (see `markup._ILLEGAL`), and the one that
# stands for bytes that are no UTF-8.
_UNPLAIN = "".join(rf"\x{i:02x}" for i in range(32) if i not in (9, 10)) + r"\ufffd-\uffff"
# A page of leaf elements and one revision, its values written with the five named references
# only. Values that are blank are left to the reader. Groups: 2 title, 5 timestamp, 7 text.
_SPACE = r"[ \t\n]*+"
_CHARACTER = f"[^<>&{_UNPLAIN}]"
_LEAVES = r"(?:<(?!title|revision|text|timestamp|page)([a-z]\w*+)>" + _CHARACTER + r"*+</\{n}>" + _SPACE + ")*+"
_VALUE = "(" + _SPACE + r"(?![ \t\n])" + _CHARACTER + "++)"
_PLAIN = (
    r"\A<page>" + _SPACE + _LEAVES.replace("{n}", "1") + "<title>" + _VALUE + "</title>" + _SPACE + _LEAVES.replace("{n}", "3")
    + "<revision>" + _SPACE + _LEAVES.replace("{n}", "4") + "(?:<timestamp>" + _VALUE + "</timestamp>" + _SPACE + ")?"
    + _LEAVES.replace("{n}", "6") + '<text(?: xml:space="preserve")?>((?:(?=' + _SPACE + r"[^ \t\n<])(?:" + _CHARACTER
    + "++|&(?:lt|gt|amp|quot|apos);)++)?)</text>" + _SPACE + "</revision>" + _SPACE + r"</page>\z"
)
# No plain page holds it.
_CUT = "\x01"


def plain_fields(raw: Column) -> Column:
    """Of a plain page: nothing, title, timestamp, text. One search tells whether a page is plain
    and cuts it."""
    return F.split(F.regexp_replace(raw, _PLAIN, f"{_CUT}$2{_CUT}$5{_CUT}$7"), _CUT)


def is_plain_page(raw: Column) -> Column:
    """Whether a record is a page that one search can take apart as the reader would."""
    return (F.get(plain_fields(raw), F.lit(0)) == "") & F.startswith(raw, F.lit("<page>"))


def plain_title(fields: Column) -> Column:
    return F.get(fields, F.lit(1))


def plain_time(fields: Column) -> Column:
    return F.nullif(F.get(fields, F.lit(2)), F.lit(""))


def plain_text(fields: Column) -> Column:
    decoded = body = F.get(fields, F.lit(3))
    for name, character in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("apos", "'"), ("amp", "&")):
        decoded = F.replace(decoded, F.lit(f"&{name};"), F.lit(character))
    return F.when(F.contains(body, F.lit("&")), decoded).otherwise(body)


def _marked(raw: Column) -> Column:
    return F.contains(raw, F.lit("<!")) | F.contains(raw, F.lit("<?"))


def is_one_page(raw: Column) -> Column:
    """Whether a record is one `page` element and nothing else, as far as markers tell; what
    they enclose is the reader's to check. Most records show it by byte searches."""
    first_end = F.instr(raw, "</page") == F.length(raw) - 6
    plain = F.startswith(raw, F.lit("<page>")) & F.endswith(raw, F.lit("</page>")) & first_end
    framed = F.rlike(raw, F.lit(r"\A\s*+<page[\s>]")) & F.rlike(raw, F.lit(r"</page\s*+>\s*+\z"))
    return F.when(plain & ~_marked(raw), F.lit(True)).otherwise(framed & _holds_one_page(raw))


def _holds_one_page(raw: Column) -> Column:
    """A state machine over the markers of a record: one `page` opens and one closes outside
    of comments, CDATA and instructions, and none of those is left open. A marker costs one
    step, whether or not what it opens is ever closed."""

    def step(acc: Column, marker: Column) -> Column:
        at = acc["at"]
        opened = (
            F.when(marker == "<!--", _COMMENT).when(marker == "<![CDATA[", _CDATA).when(marker == "<?", _INSTRUCTION).otherwise(_CONTENT)
        )
        closed = (
            ((at == _COMMENT) & (marker == "-->")) | ((at == _CDATA) & (marker == "]]>")) | ((at == _INSTRUCTION) & (marker == "?>"))
        )
        content = at == _CONTENT
        return F.struct(
            F.when(content, opened).when(closed, _CONTENT).otherwise(at).alias("at"),
            (acc["begun"] + (content & (marker == "<page")).cast("int")).alias("begun"),
            (acc["ended"] + (content & (marker == "</page")).cast("int")).alias("ended"),
        )

    start = F.struct(F.lit(_CONTENT).alias("at"), F.lit(0).alias("begun"), F.lit(0).alias("ended"))
    markers = F.regexp_extract_all(raw, F.lit(_MARKERS), F.lit(0))
    return F.aggregate(markers, start, step, lambda a: (a["at"] == _CONTENT) & (a["begun"] == 1) & (a["ended"] == 1))


def has_sections(raw: Column) -> Column:
    """Whether the text of an element may be more than one plain node."""
    first = F.instr(raw, "<text")
    after = F.substr(raw, first + 5)
    next_tag = F.substr(after, F.instr(after, "<"))
    plain = (first == 0) | (F.startswith(next_tag, F.lit("</text")) & ~F.contains(next_tag, F.lit("<text")))
    nested = F.rlike(raw, F.lit(rf"<text{_ATTRIBUTES}>[^<]*+<(?!/text)"))
    return _marked(raw) | F.when(plain, F.lit(False)).otherwise(nested)


def without_sections(raw: Column) -> Column:
    """Comments and instructions go; CDATA becomes escaped text."""
    sections = F.regexp_extract_all(raw, F.lit(_SECTION), F.lit(0))
    plain = F.transform(
        sections,
        lambda s: F.when(
            F.startswith(s, F.lit("<![CDATA[")), xml_escape(F.substring(s, F.lit(10), F.length(s) - 12))
        ).otherwise(F.lit("")),
    )
    gaps = F.split(raw, F.lit(_SECTION), F.lit(-1))
    parts = F.zip_with(gaps, plain, lambda g, p: F.concat(g, F.coalesce(p, F.lit(""))))
    return F.array_join(parts, "")


def text_bodies(raw: Column) -> Column:
    """Contents of all `text` elements; `raw` has no sections."""
    return F.regexp_extract_all(raw, F.lit(_TEXT), F.lit(1))


def own_text(body: Column) -> Column:
    """The text nodes of an element without those of its children, references decoded."""
    tags = F.regexp_extract_all(body, F.lit(_TAG), F.lit(0))
    depth = sum_before(
        tags,
        lambda t: F.when(F.startswith(t, F.lit("</")), -1).when(F.endswith(t, F.lit("/>")), 0).otherwise(1),
    )
    gaps = F.split(body, F.lit(_TAG), F.lit(-1))
    own = F.zip_with(gaps, depth, lambda g, d: F.when(d == 0, g).otherwise(F.lit("")))
    return decode_entities(F.array_join(own, ""))
