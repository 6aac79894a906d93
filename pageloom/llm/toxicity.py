"""Toxicity: Levenshtein automata run along a lexicon trie, with scores by context.

The lexicon is learned from labelled rows: whole words, and stems that a word begins with,
that mark toxic texts. All terms form a trie. The Levenshtein automata of the terms are its
states with a number of edits, taken together: a set of (trie node, edits) per letter read.
The sets are made once each and then looked up, so that a word costs a look-up per letter,
and most words end after two or three. Longer terms take more edits (SPELLING), a swap of two
letters is one edit, and words that marks cut apart are also read with their marks. A word that
is only near a term and that clean texts hold as well is a word of its own and no hit.

A hit counts by its term and edits, by how much they tell in the labelled rows, and by its
context window: hits inside quotation marks or after words of reporting count apart from
others, and so do those near words of address. A logistic regression weighs these sums.

At most TRAIN_ROWS labelled rows are learned from, chosen by a hash of their id. A term must
mark toxic texts beyond chance even among all the words there are (CHANCE).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, python_ready, staged, table

TRAIN_ROWS = 20_000
FOLDS = 5
# Candidates for the lexicon: letters of a stem, and texts that a term must mark.
STEM = (3, 8)
LEAST_TEXTS = 3
MOST_TERMS = 2_000
CHANCE = 1e-6
# Terms of fewer letters are matched as they stand where nothing is known of look-alikes.
EDIT_LETTERS = 5
# Letters from which a term takes one edit and two, where the labelled rows tell look-alikes.
SPELLING = (4, 7)
MOST_EDITS = 2
# A term counts by how often a text holds it, up to so many times.
LEVELS = 4
# Characters on either side of a hit that are its context.
WINDOW = 48
KNOWN_WORDS = 200_000
KNOWN_STATES = 50_000

_WORD = re.compile(r"[^\W_]+")
# Words that one or two marks cut apart.
_MARKED = re.compile(r"(?<![^\W_])[^\W_]++(?:(?:[^\w\s]|_){1,2}+[^\W_]++)++")
# Marks and words of quotation, words of address.
_OPENING, _CLOSING = '"“«„‘\'', '"”»“’\''
_REPORTING = frozenset("said says called calls word words term quote quoted quotes wrote".split())
_ADDRESS = frozenset("you your youre yours u ur".split())

# How much the kinds of hits count beside plain ones where the labelled rows do not say.
PRIOR = (1.0, 0.25, 0.5, 0.1, 0.25)

Hit = tuple[int, int, bool, bool]  # term, edits, quoted, addressed


class LexiconAutomaton:
    """All words within so many edits of a term: the n-th number of `spelling` is the letters
    from which a term takes n edits. A term that ends with `*` is a stem. With `swaps`, two
    letters in the wrong order are one edit. Words of `own` match as they stand only."""

    def __init__(self, terms: list[str], spelling: tuple[int, ...] = (EDIT_LETTERS,), swaps: bool = False, own: frozenset[str] = frozenset()):
        self.swaps, self.own = swaps, own
        self.children: list[dict[str, int]] = [{}]
        self.word_at: list[int | None] = [None]
        self.stem_at: list[int | None] = [None]
        self.takes = [sum(len(t.rstrip("*")) >= n for n in spelling) for t in terms]
        # The most edits that a term at the node or below it takes.
        self.most: list[int] = [0]
        for k, term in enumerate(terms):
            letters = term.rstrip("*")
            node = 0
            for c in letters:
                self.most[node] = max(self.most[node], self.takes[k])
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.word_at.append(None)
                    self.stem_at.append(None)
                    self.most.append(0)
                node = self.children[node][c]
            self.most[node] = max(self.most[node], self.takes[k])
            (self.stem_at if term.endswith("*") else self.word_at)[node] = k
        self._known: dict[str, tuple] = {}
        self._forget()

    def _forget(self) -> None:
        self._sets: dict[tuple, int] = {}
        self._members: list[tuple[tuple, frozenset]] = []
        self._moves: list[dict[str, int]] = []
        self._ends: list[tuple] = []
        self._start = self._state({(0, ""): 0}, frozenset())

    def _state(self, nodes: dict[tuple[int, str], int], stems: frozenset) -> int:
        """Members are (trie node, letter read before its turn or none): edits."""
        # Letters of the term may be missing in the word.
        todo = [n for n in nodes if not n[1]]
        while todo:
            at = todo.pop()
            e = nodes[at] + 1
            for child in self.children[at[0]].values():
                if e <= self.most[child] and e < nodes.get((child, ""), MOST_EDITS + 1):
                    nodes[child, ""] = e
                    todo.append((child, ""))
        found = dict(stems)
        ends: dict[int, int] = {}
        for (node, early), e in nodes.items():
            for k, out in ((self.stem_at[node], found), (self.word_at[node], ends)):
                if k is not None and not early and e <= self.takes[k]:
                    out[k] = min(e, out.get(k, e))
        for k, e in found.items():
            ends[k] = min(e, ends.get(k, e))
        key = (tuple(sorted(nodes.items())), frozenset(found.items()))
        if key not in self._sets:
            self._sets[key] = len(self._members)
            self._members.append(key)
            self._moves.append({})
            self._ends.append(tuple(sorted(ends.items())))
        return self._sets[key]

    def _step(self, state: int, letter: str) -> int:
        nodes: dict[tuple[int, str], int] = {}

        def reach(node: int, early: str, e: int) -> None:
            if e <= self.most[node] and e < nodes.get((node, early), MOST_EDITS + 1):
                nodes[node, early] = e

        members, stems = self._members[state]
        for (node, early), e in members:
            child = self.children[node].get(letter)
            if early:
                second = None if child is None else self.children[child].get(early)
                if second is not None:
                    reach(second, "", e)
                continue
            if child is not None:
                reach(child, "", e)
            if e < self.most[node]:
                reach(node, "", e + 1)  # a letter too many
                for other in self.children[node].values():
                    reach(other, "", e + 1)  # another letter
                    if self.swaps and letter in self.children[other]:
                        reach(node, letter, e + 1)
        self._moves[state][letter] = found = self._state(nodes, stems)
        return found

    def matches(self, word: str) -> tuple:
        """Pairs (term, edits)."""
        found = self._known.get(word)
        if found is None:
            if len(self._members) >= KNOWN_STATES:
                self._forget()
            state = self._start
            for letter in word:
                after = self._moves[state].get(letter)
                state = self._step(state, letter) if after is None else after
                if not self._members[state][0]:
                    break
            found = self._ends[state]
            if word in self.own:
                found = tuple((k, e) for k, e in found if not e)
            if len(self._known) >= KNOWN_WORDS:
                self._known.clear()
            self._known[word] = found
        return found


def _context(text: str, start: int, end: int) -> tuple[bool, bool]:
    """Whether what stands at start..end is quoted, and whether someone is addressed near it."""
    before, after = text[max(0, start - WINDOW) : start], text[end : end + WINDOW]
    open_, close = before.rstrip()[-1:], after.lstrip()[:1]
    quoted = bool(open_) and bool(close) and open_ in _OPENING and close in _CLOSING
    quoted = quoted or (before.count('"') % 2 == 1 and '"' in after)
    near = _WORD.findall(before)[-3:]
    quoted = quoted or any(w in _REPORTING for w in near)
    return quoted, any(w in _ADDRESS for w in near + _WORD.findall(after)[:3])


def _marked(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """start, end and parts of what one or two marks cut apart: they may stand for letters."""
    for run in _MARKED.finditer(text):
        parts = [(m.start(), m.end(), m[0]) for m in _WORD.finditer(text, run.start(), run.end())]
        for k, (start, end, _) in enumerate(parts):
            marks = 0
            for n in range(k + 1, min(k + MOST_EDITS + 1, len(parts))):
                marks += parts[n][0] - end
                end = parts[n][1]
                if marks > MOST_EDITS:
                    break
                yield start, end, [p[2] for p in parts[k : n + 1]]


def hits_of(automaton: LexiconAutomaton, text: str | None) -> list[Hit]:
    folded = (text or "").lower()
    out = []
    if any(map(automaton.matches, set(_WORD.findall(folded)))):
        for m in _WORD.finditer(folded):
            for term, edits in automaton.matches(m[0]):
                out.append((term, edits, *_context(folded, m.start(), m.end())))
    for start, end, parts in _marked(folded):
        found = automaton.matches(folded[start:end])
        if found:
            # What a part says counts for the part.
            said = {term for p in parts for term, _ in automaton.matches(p)}
            out += [(term, edits, *_context(folded, start, end)) for term, edits in found if term not in said]
    return out


@dataclass
class ToxicityModel:
    """terms; for each, by edits (none, one, two) and times (1 to LEVELS), the log-odds that a
    text with so many hits or more is toxic; the regression; look-alikes that are no hits."""

    terms: list[str] = field(default_factory=list)
    weights: list[list[list[float]]] = field(default_factory=list)
    coefficients: list[float] = field(default_factory=list)
    intercept: float = 0.0
    own: frozenset[str] = frozenset()

    def automaton(self) -> LexiconAutomaton:
        return LexiconAutomaton(self.terms, SPELLING, True, self.own)

    def features(self, hits: Iterable[Hit]) -> list[float]:
        """Weights of the distinct terms that were hit: plain, quoted, edited, edited and
        quoted, addressed."""
        times = Counter()
        for term, edits, quoted, addressed in hits:
            for kind in [2 * (edits > 0) + quoted] + [4] * (addressed and not quoted):
                times[term, edits, kind] += 1
        sums = [0.0] * len(PRIOR)
        for (term, edits, kind), n in times.items():
            sums[kind] += self.weights[term][edits][min(n, LEVELS) - 1]
        return sums

    def score(self, hits: Iterable[Hit]) -> float:
        x = self.intercept
        if self.coefficients:
            x += sum(c * f for c, f in zip(self.coefficients, self.features(hits), strict=True))
        return float(1 / (1 + np.exp(-np.clip(x, -30, 30))))


def held_out(id_col: Column) -> Column:
    return F.crc32(F.encode(id_col.cast("string"), "utf-8")) % FOLDS == 0


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """text, toxic: at most TRAIN_ROWS rows that are not held out. Rows without a label
    or an id are none; of several labels of an id the largest holds."""
    ids = F.col(id_col)
    known = labels.where(F.col(label_col).isNotNull() & ids.isNotNull() & ~held_out(ids))
    known = known.groupBy(ids.alias("_label_id")).agg((F.max(label_col) > 0).cast("int").alias("toxic"))
    known = known.orderBy(F.xxhash64("_label_id", F.lit(11)), "_label_id").limit(TRAIN_ROWS)
    texts = docs.select(ids.alias("_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    # TRAIN_ROWS rows at most.
    return texts.join(F.broadcast(known), F.col("_id") == F.col("_label_id")).select("text", "toxic")


def _candidates(text: str) -> set[str]:
    out = set()
    for word in set(_WORD.findall(text.lower())):
        out.add(word)
        out.update(f"{word[:k]}*" for k in range(STEM[0], min(STEM[1], len(word)) + 1))
    return out


def _counted(rows: DataFrame, only: frozenset[str] | None) -> DataFrame:
    """term, n: texts of `rows` that hold each term; counted per task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                found = _candidates(text)
                counts.update(found if only is None else found & only)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    return rows.select("text").mapInArrow(run, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))


def learn_terms(rows: DataFrame) -> list[str]:
    """Terms that mark toxic texts and do not contain one another, the most telling first."""
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return []
    marked = _counted(rows.where("toxic = 1"), None).where(F.col("n") >= LEAST_TEXTS)
    toxic = {r["term"]: r["n"] for r in marked.orderBy(F.desc("n"), "term").limit(100 * MOST_TERMS).collect()}
    clean = {r["term"]: r["n"] for r in _counted(rows.where("toxic = 0"), frozenset(toxic)).collect()}
    scored = []
    share = n_toxic / (n_toxic + n_clean)
    for term, a in toxic.items():
        b = clean.get(term, 0)
        p = a / (a + b)
        # Chernoff's bound of the chance that so many of the texts with the term are toxic.
        surprise = (a + b) * (p * np.log(p / share) + ((1 - p) * np.log((1 - p) / (1 - share)) if b else 0.0))
        if a * n_clean > 2 * b * n_toxic and surprise > -np.log(CHANCE):
            scored.append((a / n_toxic - 2 * b / n_clean, len(term), not term.endswith("*"), term))
    kept: list[str] = []
    for _, _, _, term in sorted(scored, reverse=True):
        stem = term.rstrip("*")
        # A stem and what begins with it count once.
        if not any(
            (t.endswith("*") and stem.startswith(t[:-1])) or (term.endswith("*") and t.rstrip("*").startswith(stem)) or t.rstrip("*") == stem
            for t in kept
        ):
            kept.append(term)
        if len(kept) == MOST_TERMS:
            break
    return kept


def own_words(rows: DataFrame, terms: list[str]) -> frozenset[str]:
    """Words near a term that do not mark toxic texts: clean texts hold them as often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LexiconAutomaton(terms, SPELLING, True)
        counts: Counter = Counter()
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded = text.lower()
                words = set(_WORD.findall(folded)) | {folded[start:end] for start, end, _ in _marked(folded)}
                counts.update((w, toxic) for w in words if any(e for _, e in automaton.matches(w)))
        columns = [pa.array([w for w, _ in counts], pa.string()), pa.array([y for _, y in counts], pa.int32()), pa.array(list(counts.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "toxic", "n"])

    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    near = rows.select("text", "toxic").mapInArrow(run, "word string, toxic int, n long").groupBy("word")
    near = near.agg(F.sum(F.col("n") * F.col("toxic")).alias("a"), F.sum(F.col("n") * (1 - F.col("toxic"))).alias("b"))
    # Of TRAIN_ROWS texts at most.
    return frozenset(r["word"] for r in near.where("b > 0").collect() if r["a"] * sizes.get(0, 0) <= 2 * r["b"] * sizes.get(1, 0))


def _with_hits(rows: DataFrame, terms: list[str], own: frozenset[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = LexiconAutomaton(terms, SPELLING, True, own)
        for batch in batches:
            found = [[{"t": t, "e": e, "q": q, "a": a} for t, e, q, a in hits_of(automaton, x)] for x in batch.column(0).to_pylist()]
            kind = pa.list_(pa.struct([("t", pa.int32()), ("e", pa.int32()), ("q", pa.bool_()), ("a", pa.bool_())]))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(found, kind)], names=["toxic", "hits"])

    return rows.select("text", "toxic").mapInArrow(run, "toxic int, hits array<struct<t:int,e:int,q:boolean,a:boolean>>")


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> ToxicityModel:
    """A model of `label_col`. Without rows of both classes it scores every text alike: the
    share of toxic rows, 0 if there are none."""
    python_ready(docs.sparkSession)
    # A text that many copies hold teaches once.
    rows = training_rows(docs, labels, id_col, text_col, label_col).groupBy("text").agg(F.max("toxic").alias("toxic"))
    rows = staged(rows)
    terms = learn_terms(rows)
    own = own_words(rows, terms) if terms else frozenset()
    found = [(r["toxic"], [tuple(h) for h in r["hits"]]) for r in _with_hits(rows, terms, own).collect()]
    share = sum(y for y, _ in found) / max(1, len(found))
    model = ToxicityModel(terms, _weights(terms, found), own=own)
    if not terms or len({y for y, _ in found}) < 2:
        share = min(max(share, 1e-9), 1 - 1e-9)
        return ToxicityModel(intercept=float(np.log(share / (1 - share))))
    model.coefficients, model.intercept = _regression(
        np.array([model.features(h) for _, h in found]), np.array([y for y, _ in found], dtype=float)
    )
    return model


def _weights(terms: list[str], rows: list[tuple[int, list[Hit]]]) -> list[list[list[float]]]:
    """Log-odds by term, edits and times; nothing below 0, and more times never tell less."""
    counts = np.zeros((len(terms), MOST_EDITS + 1, LEVELS, 2))
    for y, hits in rows:
        for (term, edits), n in Counter((t, e) for t, e, _, _ in hits).items():
            counts[term, edits, : min(n, LEVELS), y] += 1
    n = np.array([sum(y == 0 for y, _ in rows), sum(y == 1 for y, _ in rows)])
    odds = np.log((counts[..., 1] + 0.5) / (n[1] + 1)) - np.log((counts[..., 0] + 0.5) / (n[0] + 1))
    odds[counts.sum(axis=-1) == 0] = 0
    odds = np.maximum.accumulate(np.maximum(odds, 0), axis=2)
    # An edited form that no row shows takes half of its term's weight.
    for edits in range(1, MOST_EDITS + 1):
        unseen = counts[:, edits, 0].sum(axis=1) == 0
        odds[unseen, edits] = odds[unseen, 0] / 2
    return odds.tolist()


def _regression(x: np.ndarray, y: np.ndarray, penalty: float = 0.1) -> tuple[list[float], float]:
    """Logistic regression by Newton's method. No kind of hit speaks against toxicity: a kind
    with a negative coefficient is left out, and then counts as PRIOR says."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    used = np.count_nonzero(x, axis=0) >= 20
    used[0] = True
    while True:
        z = np.concatenate([x[:, used] / scale[used], np.ones((len(x), 1))], axis=1)
        ridge = np.diag([penalty] * int(used.sum()) + [1e-6])
        b = np.zeros(z.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
            slope = z.T @ (y - p) - ridge @ b
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, slope)
            b += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-8:
                break
        wrong = np.flatnonzero(used)[(b[:-1] < 0)]
        wrong = wrong[wrong > 0]
        if not len(wrong):
            break
        used[wrong] = False
    found = np.array(PRIOR) * max(b[0] / scale[0], 0)
    found[used] = np.maximum(b[:-1] / scale[used], 0)
    return list(map(float, found)), float(b[-1])


def score_toxicity(docs: DataFrame, model: ToxicityModel, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """`docs` with `score_col`, 0 to 1. Null and empty texts have no hits and get the score of
    a text without any; rows and other columns pass through."""
    if score_col.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"docs already has a column {score_col}")
    python_ready(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)  # MOST_TERMS terms at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = sent.value.automaton()
        for batch in batches:
            texts = batch.column(batch.schema.names.index(text_col))
            scores = [sent.value.score(hits_of(automaton, t.as_py())) for t in texts]
            yield batch.append_column(score_col, pa.array(scores, pa.float64()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())]))


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that score below 0.5; columns as in `docs`."""
    score = free_name(docs, "_toxicity")
    scored = score_toxicity(docs, train(docs, labels, text_col=text_col, **options), text_col, score)
    return scored.where(F.col(score) < 0.5).select(*docs.columns)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
