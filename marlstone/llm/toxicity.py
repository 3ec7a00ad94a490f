"""Toxicity: a learned weighted lexicon, matched by an Aho-Corasick automaton.

Texts are folded first: lower case, homoglyphs and digit substitutions to one letter each,
invisible characters away. Lexicon terms are beginnings of words (of the labelled rows), or
whole words, that mark toxic documents; phrases that labelled clean documents use around a
term are exceptions and void the hit inside them. A phrase is a sequence of whole words,
whatever stands between them, where it is learned as where it is met. The sum of the weights of the hits is
divided by the logarithm of the word count and goes through a fitted logistic curve.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.common import map_arrow, remove, slices, stored

# Characters that pass for a letter. l, i and their doubles are one letter.
LOOKALIKES = {
    "i": "l1!|ıіΙι", "o": "0оοΟО", "a": "4@аαА", "e": "3еεЕ", "s": "5$ѕЅ", "t": "7тτТ", "c": "сϲС", "p": "рρР",
    "x": "хχХ", "y": "уγУ", "h": "һН", "k": "кκК", "m": "мМ", "b": "8вВ", "n": "п", "u": "υ", "v": "ν", "j": "ј",
}
INVISIBLE = "\u200b\u200c\u200d\u2060\ufeff\u00ad"
FOLD = {ord(c): letter for letter, others in LOOKALIKES.items() for c in others} | {ord(c): None for c in INVISIBLE}
#: Lengths of beginnings; a word that is shorter or longer is also a term as a whole.
SHORTEST, LONGEST = 4, 12
#: Counts that a task holds before it hands them on.
HELD = 100_000
WORD = re.compile(r"\w+")


def fold(text: str) -> str:
    return text.lower().translate(FOLD)


def beginnings(word: str) -> Iterator[str]:
    """A word below SHORTEST has itself alone, which as a term matches whole words only; a
    word beyond LONGEST has itself, too."""
    for n in range(SHORTEST, min(len(word), LONGEST) + 1):
        yield word[:n]
    if not SHORTEST <= len(word) <= LONGEST:
        yield word


class Phrases:
    """Sequences of whole words, found by their first word."""

    def __init__(self, phrases: tuple[str, ...]):
        self._by_first: dict[str, set[tuple[str, ...]]] = {}
        for words in filter(None, (tuple(WORD.findall(fold(p))) for p in phrases)):
            self._by_first.setdefault(words[0], set()).add(words)
        self._sizes = {first: sorted({len(w) for w in own}) for first, own in self._by_first.items()}

    def __bool__(self) -> bool:
        return bool(self._by_first)

    def places(self, words: list[str]) -> Iterator[tuple[int, int]]:
        """Which words [first, end) are a phrase."""
        for i, word in enumerate(words):
            for n in self._sizes.get(word, ()):
                if tuple(words[i : i + n]) in self._by_first[word]:
                    yield i, i + n

    def spans(self, folded: str) -> list[tuple[int, int]]:
        """The characters that phrases take, from their first word to their last."""
        found = [m.span() for m in WORD.finditer(folded)]
        return [(found[a][0], found[b - 1][1]) for a, b in self.places([folded[x:y] for x, y in found])]


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = ()
    slope: float = 0.0
    intercept: float = -4.0
    _automaton: object = field(default=None, repr=False)
    _phrases: Phrases | None = field(default=None, repr=False)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"_automaton": None, "_phrases": None}

    def automaton(self):
        if self._automaton is None:
            import ahocorasick

            made = ahocorasick.Automaton()
            for term, weight in self.weights.items():
                made.add_word(term, (len(term), weight))
            made.make_automaton()
            self._automaton, self._phrases = made, Phrases(self.exceptions)
        return self._automaton

    def hits(self, folded: str) -> list[tuple[int, int, float]]:
        """(start, end, weight), the longest term per word start, outside exceptions."""
        if not self.weights:
            return []
        found: dict[int, tuple[int, int, float]] = {}
        for last, (n, weight) in self.automaton().iter(folded):
            start = last + 1 - n
            if start and folded[start - 1].isalnum():
                continue
            if n < SHORTEST and (WORD.match(folded, last + 1) or start and WORD.match(folded, start - 1)):
                continue
            if start not in found or found[start][1] <= last + 1:
                found[start] = (start, last + 1, weight)
        if not found or not self._phrases:
            return list(found.values())
        spared = sorted(self._phrases.spans(folded))
        starts, reach = [a for a, _ in spared], [0, *accumulate((b for _, b in spared), max)]
        return [h for h in found.values() if reach[bisect_right(starts, h[0])] < h[1]]

    def raw(self, text: str) -> float:
        """Weighted hits by the logarithm of the length."""
        found = self.hits(fold(text))
        return sum(w for _, _, w in found) / math.log2(2 + len(text.split())) if found else 0.0

    def score(self, text: str) -> float:
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, self.slope * self.raw(text) + self.intercept))))


def remainder(id_column: Column) -> Column:
    return F.pmod(F.crc32(id_column.cast("string")), F.lit(3))


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int) -> DataFrame:
    """(text, toxic) of at most ``most`` labelled rows that may be learned from, by smallest
    hash of the id; the bound makes the ids small enough to broadcast. Of rows that repeat an
    id one is learned from."""
    known = labels.select(F.col(f"`{id_col}`").alias("id"), F.col("toxic").cast("int").alias("toxic")).where("id IS NOT NULL AND toxic IS NOT NULL")
    known = known.where(remainder(F.col("id")) != 1).groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id", F.lit("toxicity")), "id").limit(most)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    return rows.join(F.broadcast(known), "id").groupBy("id", "toxic").agg(F.min("text").alias("text")).select("text", "toxic")


def _counted(counts: tuple[Counter, Counter], contexts: dict[str, int]) -> pa.RecordBatch:
    """The counts so far, which are then forgotten."""
    terms = list(counts[1] | counts[0])
    got = pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in (counts[1], counts[0])), pa.array([contexts.get(t, 0) for t in terms], pa.int64())], names=["term", "bad", "good", "contexts"])
    for held in (*counts, contexts):
        held.clear()
    return got


def _count_beginnings(batches: Iterator[pa.RecordBatch], exceptions: tuple[str, ...]) -> Iterator[pa.RecordBatch]:
    """Documents, by label, that have a word beginning, given exceptions aside. contexts: of
    toxic documents, which of 60 hashes the word before had. A task hands its counts on
    before they grow large."""
    phrases = Phrases(exceptions)
    counts, contexts = (Counter(), Counter()), {}
    for batch in slices(batches, "text"):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = WORD.findall(fold(text))
            if phrases:
                spared = {i for a, b in phrases.places(words) for i in range(a, b)}
                words = [w for i, w in enumerate(words) if i not in spared]
            before = dict(zip(reversed(words), [*reversed(words[:-1]), ""], strict=True))
            own = {b: 1 << zlib.crc32(before[w].encode()) % 60 for w in before for b in beginnings(w)}
            counts[toxic > 0].update(own.keys())
            if toxic > 0:
                for b, bit in own.items():
                    contexts[b] = contexts.get(b, 0) | bit
            if len(counts[0]) + len(counts[1]) > HELD:
                yield _counted(counts, contexts)
    yield _counted(counts, contexts)


def _count_pairs(batches: Iterator[pa.RecordBatch], terms: frozenset[str]) -> Iterator[pa.RecordBatch]:
    """Documents, by label, that have a pair of words one of which begins with a term."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in slices(batches, "text"):
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = WORD.findall(fold(text))
            marked = {w for w in set(words) if not terms.isdisjoint(beginnings(w))}
            counts[toxic > 0].update({f"{a} {b}" for a, b in zip(words, words[1:], strict=False) if a in marked or b in marked} if marked else ())
            if len(counts[0]) + len(counts[1]) > HELD:
                yield _counted(counts, {})
    yield _counted(counts, {})


_COUNTS = "term string, bad bigint, good bigint, contexts bigint"


def _best_terms(candidates: dict[str, tuple[int, int, float]]) -> dict[str, float]:
    """Weights of the terms to keep: of beginnings of each other with the same rows the
    longest, of the others the shortest."""
    twins = {(c[:-1], *candidates[c][:2]) for c in candidates if len(c) > SHORTEST}
    weights: dict[str, float] = {}
    for term in sorted(candidates, key=lambda t: (len(t), t)):
        shorter = beginnings(term[:-1]) if len(term) > SHORTEST else ()
        if (term, *candidates[term][:2]) not in twins and not any(b in weights for b in shorter):
            weights[term] = round(candidates[term][2], 4)
    return weights


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_rows: int = 12_000, least_documents: int = 4, chance: float = 1e-5, least_odds: float = 3.0, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from labelled rows whose crc32(id as text) mod 3 isn't 1.

    Copies of a toxic text say the same thing again, so evidence is counted in different
    words before the beginning, not in rows. A beginning is a term if it has
    ``least_documents`` of them in toxic rows, which by the share of toxic rows would happen
    with less than ``chance``, and stands far more often in toxic rows. Pairs of words with
    a term that three clean rows and no toxic one have are exceptions, beside those given.
    At most ``most_rows`` rows are read, which bounds the terms and exceptions too: none is
    left out. Without labelled rows of both kinds the lexicon is empty and all scores are low.
    """
    rows, path = stored(docs.sparkSession, training_rows(docs, labels, id_col, text_col, most_rows), "training")
    try:
        whole = rows.agg(F.count("*").alias("n"), F.count_if(F.col("toxic") > 0).alias("bad")).first()
        bad_rows, good_rows = whole["bad"], whole["n"] - whole["bad"]
        if not bad_rows or not good_rows:
            return Lexicon({}, exceptions)
        counted = map_arrow(rows, lambda batches: _count_beginnings(batches, exceptions), _COUNTS).groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.bit_count(F.bit_or("contexts")).alias("contexts"))
        odds = F.log((F.col("bad") + 0.5) / (bad_rows + 1.0)) - F.log((F.col("good") + 0.5) / (good_rows + 1.0))
        unlikely = F.col("contexts") * math.log(bad_rows / (bad_rows + good_rows)) < math.log(chance)
        strong = counted.where((F.col("contexts") >= least_documents) & unlikely & (odds > least_odds)).select("term", "bad", "good", odds.alias("odds"))
        weights = _best_terms({r["term"]: (r["bad"], r["good"], r["odds"]) for r in strong.collect()})
        if not weights:
            return Lexicon({}, exceptions)
        pairs = map_arrow(rows, lambda batches: _count_pairs(batches, frozenset(weights)), _COUNTS).groupBy("term").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
        learned = tuple(sorted(r["term"] for r in pairs.where("bad = 0 AND good >= 3").collect()))
        lexicon = Lexicon(weights, exceptions + learned)
        lexicon.slope, lexicon.intercept = _logistic(*_features(rows, lexicon))
        return lexicon
    finally:
        remove(docs.sparkSession, path)


def _features(rows: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray]:
    """Of at most most_rows rows, in an order of their own: sums then don't depend on tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            yield pa.RecordBatch.from_arrays([pa.array([lexicon.raw(t) for t in batch.column(0).to_pylist()], pa.float64()), batch.column(1).cast(pa.int32())], names=["x", "y"])

    got = map_arrow(rows, run, "x double, y int").toArrow()
    x, y = got.column(0).to_numpy(), got.column(1).to_numpy().astype(float)
    order = np.lexsort((y, x))
    return x[order], y[order]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 60) -> tuple[float, float]:
    """Newton's method on the class-balanced log loss."""
    weight = np.where(y > 0, 0.5 / max(y.sum(), 1), 0.5 / max((1 - y).sum(), 1))
    design, beta = np.c_[x, np.ones(len(x))], np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -60, 60)))
        gradient = design.T @ (weight * (p - y)) + ridge * beta
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        beta -= np.clip(np.linalg.solve(hessian, gradient), -5, 5)
    return float(beta[0]), float(beta[1])


def score(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts have no hits and the lowest score. Repeated rows are scored each;
    the remainder of a null doc_id is null, and so is its held_out. An empty table gives no
    rows; further columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), (remainder(F.col(f"`{id_col}`")) == 1).alias("held_out"), F.col(f"`{text_col}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            texts = [t or "" for t in batch.column(2).to_pylist()]
            scores = [lexicon.score(t) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    return map_arrow(rows, run, "doc_id bigint, held_out boolean, score double, predicted int")


def keep(docs: DataFrame, lexicon: Lexicon, text_col: str = "text", threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
            yield batch.filter(pa.array([lexicon.score(t or "") < threshold for t in texts], pa.bool_()))

    return map_arrow(docs, run, docs.schema)
