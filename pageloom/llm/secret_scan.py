"""Secret scan over a trigram index, in DataFrame functions only.

Each rule's regular expression yields a Boolean trigram query (`trigrams`). The index holds,
for each trigram that some query asks for, which documents contain it: posting bitmaps, one
bit per document and trigram, kept beside the documents. Intersecting postings is therefore
AND and OR of bits where the text lies; no postings and no text are shuffled. Rules run only
on their candidates; a rule without a mandatory trigram runs on all documents.

Positions come from cutting the text at the matches: a match starts after the lengths of all
pieces and matches before it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import bound, running, sum_before
from .common import free_name, table
from .trigrams import evaluate, grams_of, trigram_query


@dataclass(frozen=True)
class Rule:
    """A match counts if its `group` has `least` characters or more; one that has fewer is
    dropped, but what it has consumed stays consumed."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# The kinds of the contract, in its order.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2, 12, True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 18, True),
    Rule("hex", r"[0-9a-f]{16,}", 0, 16, True),  # maximal runs, as with + and a length check
)
# Public formats of further credentials.
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("github", r"gh[posu]_[A-Za-z0-9]{36,}"),
)
RULES = BASE_RULES + MORE_RULES
# A key runs to its END line, or to the end of its base64 lines where that is missing or cut.
# All repeats are possessive: a long text costs one pass and no stack.
_BLANK = r"""(?:[\s>"',|#*;]|\\[nrt])*+"""
PEM_KEY = (
    MORE_RULES[0].pattern
    + r"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----"
    + rf"|(?:{_BLANK}(?:Proc-Type|DEK-Info|[A-Z][A-Za-z]*+-[A-Za-z-]*+): [^\r\n\\]*+)*+"
    + rf"(?:{_BLANK}[A-Za-z0-9+/]{{16,}}+=*+|(?:\r?\n|\\n)[\t >]*+[A-Za-z0-9+/]++=*+(?=[\t ]*+(?:[\r\n]|\\[nr]|$)))*+)"
)
# What is masked: whole keys. The spans of the query stay those of its SQL, which ends at the header.
MASKED_RULES = tuple(Rule("pem", PEM_KEY) if r.kind == "pem" else r for r in RULES)


def gram_index(docs: DataFrame, rules: tuple[Rule, ...], text_col: str, grams: str) -> DataFrame:
    """`docs` with a column `grams`: which of the trigrams asked for the text contains."""
    asked = sorted(set().union(*(grams_of(trigram_query(r.pattern)) for r in rules)))
    folded = free_name(docs, "_folded")
    posted = [F.when(F.contains(F.col(folded), F.lit(g)), F.lit(g)) for g in asked]
    docs = docs.withColumn(folded, F.lower(F.col(text_col)))
    return docs.withColumn(grams, F.array_compact(F.array(*posted))).drop(folded)


def find_secrets(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", spans_col: str = "spans"
) -> DataFrame:
    """`docs` with `spans_col`: array<struct<start int, kind string, end int>> by start, then
    by the order of the rules; code points, end exclusive. A null or empty text has none;
    overlapping spans of different kinds all stay; rows, also repeated ones, and all other
    columns pass through unchanged (internal names avoid theirs)."""
    own = {n: free_name(docs, f"_{n}") for n in ("text", "grams")}
    found = docs.withColumn(own["text"], F.coalesce(F.col(text_col), F.lit("")))
    found = gram_index(found, rules, own["text"], own["grams"])
    names = [[free_name(docs, f"_{n}{i}") for n in ("hits", "gaps", "values", "before", "spans")] for i in range(len(rules))]
    text, none = F.col(own["text"]), F.array().cast("array<string>")

    def all_of(rule: Rule, group: int) -> Column:
        return F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(group))

    def has(gram: str) -> Column:
        return F.array_contains(own["grams"], gram)

    found = found.withColumns(
        {
            hits: F.when(evaluate(trigram_query(rule.pattern), has), all_of(rule, 0)).otherwise(none)
            for rule, (hits, *_) in zip(rules, names, strict=True)
        }
    )
    lengths = {}
    for rule, (hits, gaps, values, *_) in zip(rules, names, strict=True):
        any_hit, no_length = F.size(hits) > 0, F.array().cast("array<int>")
        pieces = F.split(text, F.lit(rule.pattern), F.lit(-1))
        lengths[gaps] = F.when(any_hit, F.transform(pieces, F.length)).otherwise(no_length)
        group = F.col(hits) if rule.group == 0 else all_of(rule, rule.group)
        lengths[values] = F.when(any_hit, F.transform(group, F.length)).otherwise(no_length)
    found = found.withColumns(lengths)
    found = found.withColumns(
        {
            before: sum_before(F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.length(h) + g))
            for hits, gaps, _, before, _ in names
        }
    )
    found = found.withColumns(
        {n[4]: _spans_of(i, rule, *n[:4]) for i, (rule, n) in enumerate(zip(rules, names, strict=True))}
    )
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    ordered = F.array_sort(F.concat(*[F.col(n[4]) for n in names]))
    spans = F.transform(
        ordered, lambda s: F.struct(s["start"].alias("start"), kinds[s["rank"]].alias("kind"), s["end"].alias("end"))
    )
    return found.withColumn(spans_col, spans).drop(*own.values(), *[x for n in names for x in n])


def _spans_of(rank: int, rule: Rule, hits: str, gaps: str, values: str, before: str) -> Column:
    def span(hit: Column, i: Column) -> Column:
        start = F.col(before)[i] + F.col(gaps)[i]
        return F.struct(start.alias("start"), F.lit(rank).alias("rank"), (start + F.length(hit)).alias("end"))

    long_enough = F.transform(values, lambda v: v >= rule.least)
    paired = F.zip_with(F.transform(hits, span), long_enough, lambda s, ok: F.struct(s.alias("s"), ok.alias("ok")))
    return F.transform(F.filter(paired, lambda p: p["ok"]), lambda p: p["s"])


def spans_text(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = MASKED_RULES, text_col: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """`docs` with each run of overlapping spans in the text replaced by `mask`. Texts without
    spans, null ones included, stay as they are."""
    spans, runs = free_name(docs, "_spans"), free_name(docs, "_runs")
    found = find_secrets(docs, rules, text_col, spans)
    found = found.withColumn(runs, _runs_of(F.col(spans)))
    text = F.col(text_col)
    masked = F.when(F.size(runs) > 0, _masked(text, F.col(runs), mask)).otherwise(text)
    return found.withColumn(text_col, masked).select(*docs.columns)


def _runs_of(spans: Column) -> Column:
    """Overlapping and touching spans (by start) as one: array<struct<start, end>>."""

    # What the spans before each reach to.
    reached = F.concat(F.array(F.lit(-1)), running(F.transform(spans, lambda s: s["end"]), F.lit(-1), F.greatest))
    marked = bound(reached, lambda r: F.transform(spans, lambda s, i: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.get(r, i).alias("reach"))))

    def runs(all_: Column) -> Column:
        first = F.filter(all_, lambda s: s["start"] > s["reach"])
        # A run ends where everything before the next one reaches to.
        last = F.array_max(F.transform(all_, lambda s: s["end"]))
        return bound(first, lambda own: F.transform(own, lambda s, i: F.struct(s["start"].alias("start"), F.coalesce(F.get(own, i + 1)["reach"], last).alias("end"))))

    return F.when(F.size(spans) > 0, bound(marked, runs)).otherwise(F.array().cast("array<struct<start:int,end:int>>"))


# Texts are cut in blocks of so many characters, so that a piece is found without going
# through the text from its start.
_BLOCK_CHARS = 2048


def _masked(text: Column, runs: Column, mask: str) -> Column:
    """`text` with each of the disjoint `runs` (by start) replaced. The text is cut where a
    block or a run begins or ends; a piece lies in one block and stays if no run is open."""

    def cut(at: Column, opens: int) -> Column:
        return F.struct(at.cast("int").alias("at"), F.lit(opens).alias("opens"))

    def of_blocks(blocks: Column) -> Column:
        begins = F.transform(blocks, lambda _, i: cut(i * _BLOCK_CHARS, 0))
        edges = F.flatten(F.transform(runs, lambda r: F.array(cut(r["start"], 1), cut(r["end"], -1))))
        return bound(F.array_sort(F.concat(begins, edges)), lambda cuts: of_cuts(blocks, cuts))

    def of_cuts(blocks: Column, cuts: Column) -> Column:
        return bound(sum_before(cuts, lambda c: c["opens"]), lambda open_: F.array_join(F.transform(cuts, piece(blocks, cuts, open_)), ""))

    def piece(blocks: Column, cuts: Column, open_: Column):
        def of(c: Column, i: Column) -> Column:
            to = F.coalesce(F.get(cuts, i + 1)["at"], c["at"] + _BLOCK_CHARS)
            block = F.get(blocks, F.floor(c["at"] / _BLOCK_CHARS).cast("int"))
            kept = F.coalesce(F.substr(block, c["at"] % _BLOCK_CHARS + 1, to - c["at"]), F.lit(""))
            return F.when(c["opens"] == 1, F.lit(mask)).when(F.get(open_, i + 1) == 0, kept).otherwise(F.lit(""))

        return of

    return bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{_BLOCK_CHARS}}}"), F.lit(0)), of_blocks)


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    base = [r.kind for r in BASE_RULES]
    found = find_secrets(docs).withColumn("base", F.filter("spans", lambda s: s["kind"].isin(base)))

    def count_of(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count_of, base),
        F.sha2(F.encode(spans_text(F.col("base")), "utf-8"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


def _oracle() -> str:
    """The same spans with DuckDB's regular expressions, rule by rule, without any index."""
    parts = []
    for rank, r in enumerate(RULES):
        p = r.pattern.replace("'", "''")
        parts.append(
            f"SELECT rid, {rank} AS rank, '{r.kind}' AS kind, {r.least} AS least, "
            f"regexp_extract_all(t, '{p}', 0) AS hits, regexp_extract_all(t, '{p}', {r.group}) AS vals, "
            f"string_split_regex(t, '{p}') AS gaps FROM docs"
        )
    return f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(parts)}),
each_hit AS (
  SELECT rid, rank, kind, least, hits, vals, gaps, unnest(range(1, len(hits) + 1)) AS i FROM found
),
spans AS (
  SELECT rid, rank, kind,
    (list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0))::BIGINT AS start,
    length(hits[i]) AS n
  FROM each_hit WHERE length(vals[i]) >= least
),
per_doc AS (
  SELECT rid,
    count(*) FILTER (kind = 'assign') AS n_assign,
    count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, rank) FILTER (rank < {len(BASE_RULES)}) AS base,
    string_agg(kind || ':' || start || ':' || (start + n), ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY rid
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN per_doc USING (rid)"""


ORACLE = {"op3_secret_scan": _oracle()}
