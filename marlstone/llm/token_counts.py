"""Token counts by rank-synchronous array merging.

Unseen pre-tokens of a batch are held as one ragged numpy array of symbols. In each round
every sequence finds its own lowest-rank adjacent pair and all sequences apply theirs at
once; a sequence without a known pair is finished and its surviving symbols are counted.
A long sequence would take as many rounds over itself as it has ranks; from LONG bytes on a
sequence keeps its ranks between rounds with the places of each, so that a round touches only
the places it merges and those beside them. Counts of chunks (see bpe.chunks) are remembered
in a bounded dictionary.
"""

from __future__ import annotations

import functools
import heapq
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marlstone.llm import bpe
from marlstone.llm.common import ids_and_texts, map_arrow, slices

NONE = np.iinfo(np.int32).max
LONG = 400


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies: bytes
    that print stand for themselves, the others follow from code point 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(256, 512))
    return [chr(b if b in own else next(others)) for b in range(256)]


class Merges:
    """Pair -> (rank, merged symbol), as sorted arrays."""

    def __init__(self, vocabulary: dict[str, int], merges: list):
        self.of_byte = np.array([vocabulary[c] for c in byte_alphabet()], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([vocabulary[a] << 20 | vocabulary[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)

    @classmethod
    def load(cls, path: str) -> Merges:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        return cls(model["vocab"], model["merges"])

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def count(self, tokens: list[bytes]) -> np.ndarray:
        """Symbols left of each pre-token."""
        long = [i for i, t in enumerate(tokens) if len(t) >= LONG]
        if long:
            short = [t for t in tokens if len(t) < LONG]
            result = np.zeros(len(tokens), np.int64)
            result[[i for i, t in enumerate(tokens) if len(t) < LONG]] = self._count_short(short)
            result[long] = [self._count_long(tokens[i]) for i in long]
            return result
        return self._count_short(tokens)

    def _count_long(self, token: bytes) -> int:
        """Of one pre-token: all places of its lowest rank are merged at once, and only the pairs
        they are part of get new ranks."""
        symbols = self.of_byte[np.frombuffer(token, np.uint8)]
        left = n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        rank = np.full(n, NONE, np.int32)
        rank[:-1] = self.rank(symbols[:-1], symbols[1:])
        filed: dict[int, list[np.ndarray]] = {}
        waiting: list[int] = []

        def file(at: np.ndarray) -> None:
            at = at[rank[at] != NONE]
            if not len(at):
                return
            at = at[np.argsort(rank[at], kind="stable")]
            own = rank[at]
            starts = np.flatnonzero(np.diff(own, prepend=-1))
            for r, places in zip(own[starts].tolist(), np.split(at, starts[1:]), strict=True):
                if r not in filed:
                    filed[r] = []
                    heapq.heappush(waiting, r)
                filed[r].append(places)

        if n > 1:
            file(np.arange(n))
        while waiting:
            lowest = heapq.heappop(waiting)
            at = np.unique(np.concatenate(filed.pop(lowest)))
            at = at[rank[at] == lowest]  # places merged since then have another rank
            if not len(at):
                continue
            index = np.arange(len(at))
            linked = np.concatenate([[False], after[at[:-1]] == at[1:]])
            at = at[(index - np.maximum.accumulate(np.where(linked, 0, index))) % 2 == 0]
            gone = after[at]
            symbols[at] = self.made[lowest]
            rank[gone] = NONE
            after[at] = after[gone]
            behind = after[at]
            before[behind[behind < n]] = at[behind < n]
            touched = np.unique(np.concatenate([at, before[at]]))
            touched = touched[touched >= 0]
            end = after[touched] >= n
            rank[touched[end]] = NONE
            touched = touched[~end]
            rank[touched] = self.rank(symbols[touched], symbols[after[touched]])
            file(touched)
            left -= len(gone)
        return left

    def _count_short(self, tokens: list[bytes]) -> np.ndarray:
        lengths = np.array([len(t) for t in tokens], np.int64)
        result = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(tokens), np.uint8)]
        owner = np.repeat(np.arange(len(tokens)), lengths)
        while len(symbols) > 1:
            rank = np.full(len(symbols), NONE, np.int32)
            same = owner[:-1] == owner[1:]
            rank[:-1][same] = self.rank(symbols[:-1][same], symbols[1:][same])
            starts = np.flatnonzero(np.r_[True, ~same])
            lowest = np.minimum.reduceat(rank, starts)
            sizes = np.diff(np.r_[starts, len(symbols)])
            each = np.repeat(lowest, sizes)
            hit = (rank == each) & (rank != NONE)
            # equal symbols in a row give overlapping hits: every second one of a run counts
            at = np.flatnonzero(hit)
            if not len(at):
                result[owner[starts]] = sizes
                return result
            run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            done = lowest == NONE
            result[owner[starts[done]]] = sizes[done]
            keep &= each != NONE
            symbols, owner = symbols[keep], owner[keep]
        result[owner] = 1
        return result


class ChunkCounts:
    """Token counts of texts; what chunks count is remembered, boundedly."""

    def __init__(self, merges: Merges, pattern: str):
        import regex

        self.merges, self.find, self.known = merges, regex.compile(pattern).findall, {}

    def _learn(self, unseen: list[str]) -> None:
        cut = [self.find(x) for x in unseen]
        distinct = list({t for tokens in cut for t in tokens})
        of = dict(zip(distinct, self.merges.count([t.encode() for t in distinct]).tolist(), strict=True)) if distinct else {}
        for x, tokens in zip(unseen, cut, strict=True):
            self.known[x] = sum(map(of.__getitem__, tokens))

    def texts(self, texts: list[str]) -> list[int]:
        """Counts of whole texts; a special string counts one wherever it stands."""
        if len(self.known) > bpe.MEMORY:
            self.known.clear()
        parts = [[p for p in (t.split(bpe.SPECIAL) if bpe.SPECIAL in t else (t,))] for t in texts]
        held = [[bpe.chunks(p) for p in ps] for ps in parts]
        # all chunks of a text but the first start with a blank
        held = [[c[:1] + [" " + x for x in c[1:]] for c in cs] for cs in held]
        unseen = set()
        for cs in held:
            for c in cs:
                unseen.update(c)
        self._learn([x for x in unseen if x not in self.known])
        out = [len(cs) - 1 + sum(sum(map(self.known.__getitem__, c)) for c in cs) for cs in held]
        for x in [x for x in unseen if len(x) > bpe.LONGEST]:
            del self.known[x]
        return out


@functools.lru_cache(maxsize=4)
def chunk_counts(tokenizer_path: str, pattern: str) -> ChunkCounts:
    """One memory for all tasks that a Python worker runs."""
    return ChunkCounts(Merges.load(tokenizer_path), pattern)


def token_counts(docs: DataFrame, tokenizer_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens. Repeated rows are counted each, a null
    doc_id stays null, an empty table gives no rows, further columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = chunk_counts(tokenizer_path, pattern)
        for batch in slices(batches, "text", 4 << 20):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            n = counts.texts(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return map_arrow(ids_and_texts(docs, id_col, text_col), run, "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
