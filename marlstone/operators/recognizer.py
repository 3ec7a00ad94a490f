"""A learned recogniser of names: an averaged perceptron over tokens, decoded by Viterbi.

It learns from mentions that the patterns and the table of abbreviations find by themselves. For
a share of them in training the word itself is hidden, so that endings, shapes and
neighbours have to tell a name; what it then finds beyond the patterns are names of other
shapes in the same company. Every feature is of one token in one of three places (the one
to be tagged, the one before, the one behind), so a token's part of a score is worked out
once and looked up from then on.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.operators.mentions import ABBREVIATION, EXCLUDED, IN_PARENTHESES, PREFIXED

OUT, BEGIN, INSIDE = range(3)
TAGS, BUCKETS = 3, 1 << 15
TOKEN = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*|\d+|[^\w\s]|_")
#: Where a text is cut for decoding, and the most tokens decoded at a time.
_END, LONGEST = {".", "!", "?", ";"}, 200
HERE, BEFORE, BEHIND = range(3)


def tokens_of(text: str) -> list[tuple[str, int, int]]:
    return [(m[0], m.start(), m.end()) for m in TOKEN.finditer(text)]


def pattern_spans(text: str, abbreviations: frozenset[str]) -> list[tuple[int, int]]:
    """Characters of the mentions that patterns and abbreviations give, the longer first of
    those that overlap."""
    found = [m.span() for m in re.finditer(IN_PARENTHESES, text)] + [m.span() for m in re.finditer(PREFIXED, text) if not re.fullmatch(EXCLUDED, m[0])]
    found += [m.span() for m in re.finditer(ABBREVIATION, text) if m[0] in abbreviations]
    kept: list[tuple[int, int]] = []
    for a, b in sorted(found, key=lambda s: (s[0] - s[1], s)):
        if all(b <= x or y <= a for x, y in kept):
            kept.append((a, b))
    return sorted(kept)


def tags_of(tokens: list[tuple[str, int, int]], spans: list[tuple[int, int]]) -> list[int]:
    tags, at = [], 0
    for _, a, b in tokens:
        while at < len(spans) and spans[at][1] <= a:
            at += 1
        inside = at < len(spans) and spans[at][0] < b
        tags.append(OUT if not inside else BEGIN if a <= spans[at][0] else INSIDE)
    return tags


def _shape(token: str) -> str:
    return re.sub(r"(.)\1+", r"\1", "".join("X" if c.isupper() else "x" if c.islower() else "9" if c.isdigit() else c for c in token))


def features(token: str, place: int, hidden: bool = False) -> list[int]:
    """Numbers of a token's features; ``hidden`` leaves out those that name the word."""
    low = token.lower()
    named = [] if hidden else [f"w{low}", f"p{low[:3]}", f"q{low[:4]}"]
    told = [*named, f"s{low[-3:]}", f"t{low[-4:]}", f"h{_shape(token)}", "1"] if place == HERE else [f"w{low}", f"s{low[-3:]}", f"h{_shape(token)}"]
    return [zlib.crc32(f"{place}{x}".encode()) % BUCKETS for x in told]


EDGE = "\n"  # stands before the first token and behind the last


@dataclass
class Tagger:
    weights: np.ndarray
    steps: np.ndarray  # from a tag (or TAGS: none) to the next
    _known: dict = field(default_factory=dict, repr=False)

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "steps": self.steps, "_known": {}}

    def _part(self, token: str, place: int) -> np.ndarray:
        part = self._known.get((token, place))
        if part is None:
            if len(self._known) > 200_000:
                self._known.clear()
            part = self._known[token, place] = self.weights[features(token, place)].sum(axis=0)
        return part

    def scores(self, words: list[str]) -> np.ndarray:
        """What each tag has for each token, by its own features."""
        around = [EDGE, *words, EDGE]
        return np.array([self._part(w, HERE) + self._part(around[i], BEFORE) + self._part(around[i + 2], BEHIND) for i, w in enumerate(words)])

    def decode(self, words: list[str]) -> list[int]:
        return viterbi(self.scores(words), self.steps) if words else []

    def spans(self, text: str) -> list[tuple[int, int]]:
        """Characters of the names of a text."""
        out, part = [], []
        tokens = tokens_of(text)
        for i, token in enumerate(tokens):
            part.append(token)
            if token[0] in _END or len(part) >= LONGEST or i + 1 == len(tokens):
                begin = None
                for (_, a, b), tag in zip(part, self.decode([w for w, _, _ in part]), strict=True):
                    if tag == INSIDE and begin is not None:
                        out[-1] = (begin, b)
                    elif tag == OUT:
                        begin = None
                    else:
                        begin = a
                        out.append((a, b))
                part = []
        return out

    def names(self, text: Column) -> Column:
        """The names of a text, as mentions() takes a recogniser."""

        @F.pandas_udf("array<string>")
        def found(texts: pd.Series) -> pd.Series:
            return texts.map(lambda t: [t[a:b] for a, b in self.spans(t)] if t else [])

        return found(text)


def viterbi(scores: np.ndarray, steps: np.ndarray) -> list[int]:
    """The tags of the largest sum; of equal ones the lower tag, from the end on."""
    best, back = (scores[0] + steps[TAGS]).tolist(), []
    move = steps[:TAGS].tolist()
    for own in scores[1:].tolist():
        ways = [max(range(TAGS), key=lambda t, to=to: (best[t] + move[t][to], -t)) for to in range(TAGS)]
        best = [best[t] + move[t][to] + own[to] for to, t in enumerate(ways)]
        back.append(ways)
    tags = [max(range(TAGS), key=lambda t: (best[t], -t))]
    for ways in reversed(back):
        tags.append(ways[tags[-1]])
    return tags[::-1]


def fitted(windows: list[tuple[list[str], list[int]]], rounds: int = 6, hide: float = 0.5, seed: int = 3) -> Tagger:
    """Averaged over all steps; a window is tokens and tags."""
    r = random.Random(seed)
    weights, steps = np.zeros((BUCKETS, TAGS)), np.zeros((TAGS + 1, TAGS))
    summed, summed_steps, now = np.zeros_like(weights), np.zeros_like(steps), 1
    steps[[OUT, TAGS], INSIDE] = -1e6  # a name doesn't begin inside
    order = list(windows)
    for _ in range(rounds):
        r.shuffle(order)
        for words, tags in order:
            around = [EDGE, *words, EDGE]
            hidden = False
            rows = []
            for i, w in enumerate(words):
                hidden = (r.random() < hide) if tags[i] == BEGIN else hidden and tags[i] == INSIDE
                rows.append(features(w, HERE, hidden) + features(around[i], BEFORE) + features(around[i + 2], BEHIND))
            got = viterbi(np.array([weights[x].sum(axis=0) for x in rows]), steps)
            if got != tags:
                last_g = last_t = TAGS
                for x, g, t in zip(rows, got, tags, strict=True):
                    if g != t:
                        for of, table in ((1.0, weights), (float(now), summed)):
                            np.add.at(table[:, t], x, of)
                            np.add.at(table[:, g], x, -of)
                    if (last_g, g) != (last_t, t):
                        for of, table in ((1.0, steps), (float(now), summed_steps)):
                            table[last_t, t] += of
                            table[last_g, g] -= of
                    last_g, last_t = g, t
            now += 1
    return Tagger((weights - summed / now).astype(np.float32), steps - summed_steps / now)


def windows_of(docs: DataFrame, abbreviations: DataFrame, most_windows: int, around: int) -> list[tuple[list[str], list[int]]]:
    """Windows of tokens around mentions, and as many without one; those of smallest hash."""
    terms = frozenset(r.abbrev for r in abbreviations.select("abbrev").collect())  # a dimension of fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(0).to_pylist():
                tokens = tokens_of(text or "")
                tags = tags_of(tokens, pattern_spans(text or "", terms))
                starts = [i for i, t in enumerate(tags) if t == BEGIN]
                for n, i in enumerate(starts):
                    a, b = max(0, i - around), min(len(tokens), i + around + 4)
                    rows.append(([w for w, _, _ in tokens[a:b]], tags[a:b]))
                    far = (i + len(tokens) // 2 + 37 * n) % len(tokens)
                    if BEGIN not in tags[far : far + 2 * around] and INSIDE not in tags[far : far + 2 * around]:
                        rows.append(([w for w, _, _ in tokens[far : far + 2 * around]], tags[far : far + 2 * around]))
            rows = [(w, [OUT if t == INSIDE and BEGIN not in tags[:k] else t for k, t in enumerate(tags)]) for w, tags in rows]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in rows], pa.list_(pa.string())), pa.array([t for _, t in rows], pa.list_(pa.int32()))], names=["words", "tags"])

    found = docs.select("text").mapInArrow(run, "words array<string>, tags array<int>").distinct()
    kept = found.orderBy(F.xxhash64("words", "tags"), "words").limit(most_windows).collect()
    return [(r.words, list(r.tags)) for r in kept]


def train(docs: DataFrame, abbreviations: DataFrame, most_windows: int = 3000, around: int = 8, rounds: int = 6, hide: float = 0.5) -> Tagger | None:
    """A tagger for the texts of (doc_id, text), from at most ``most_windows`` windows of about
    ``2 * around`` tokens; None where the patterns find nothing to learn from. The same rows
    give the same tagger."""
    windows = windows_of(docs, abbreviations, most_windows, around)
    return fitted(windows, rounds, hide) if windows else None
