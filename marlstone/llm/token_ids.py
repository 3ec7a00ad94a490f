"""Token ids of whole texts by the tokenizers library, which sees each distinct chunk of a slice
of texts once.

A byte-level pre-token holds a blank only as its first character and a line feed between two
other characters is one of its own. So a single blank or line feed between two characters
that are no white space starts a chunk that is encoded by itself, whatever stands around it.
Chunks are told apart by Arrow, looked up in a bounded memory, encoded many in one text where
their ids show where each begins, and put together with numpy. Runs of white space, special
strings and whatever else stays inside a chunk and goes to the library as it is.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPECIAL = "<|endoftext|>"
#: What a chunk starts with, by its kind: nothing (first of a text), a blank, a line feed, the special string.
LEADS = ("", " ", "\n", SPECIAL)
FIRST, BLANK, LINE, AFTER_SPECIAL = range(4)
_SPACES = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]"
_ODD = rf"[ \n]{_SPACES}|{_SPACES}[ \n]|{re.escape(SPECIAL)}"
_CUT = re.compile(r"(?<=\S)([ \n])(?=\S)")
#: Chunks a worker remembers, the longest that is remembered (some 60 MB), and how many are
#: encoded in one text.
MEMORY, LONGEST, TOGETHER = 250_000, 48, 512


def ragged_take(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces pool[starts : starts + lengths] that ``which`` names, one behind the other,
    and where each ends."""
    sizes = lengths[which]
    ends = np.cumsum(sizes)
    at = np.repeat(starts[which] - (ends - sizes), sizes)
    at += np.arange(len(at))
    return pool[at], ends


def slices(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of each have about ``most_bytes``; a longer text is alone."""
    for batch in batches:
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(sizes, (sizes[start - 1] if start else 0) + most_bytes, "right"))
            end = max(end, start + 1)
            yield batch.slice(start, end - start)
            start = end


class TokenIds:
    """Encodes texts; ``encode`` gives each text's ids as the library does."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        tokens = self._library.get_vocab()
        self.size = max(tokens.values()) + 1
        self._starts = {BLANK: np.zeros(self.size, bool), LINE: np.zeros(self.size, bool)}
        for token, i in tokens.items():  # the printable stand-ins of a blank and a line feed
            self._starts[BLANK][i] = token.startswith("Ġ")
            self._starts[LINE][i] = token == "Ċ"
        # chunks met of late, and those met before them, of which the ones met again stay
        self._known: dict[int, tuple[dict, dict]] = {kind: ({}, {}) for kind in (BLANK, LINE, AFTER_SPECIAL)}

    def _library_ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, np.uint32).tobytes() for e in self._library.encode_batch_fast(texts, add_special_tokens=False)]

    def _together(self, kind: int, words: list[str]) -> list[bytes]:
        """Ids of words without white space behind a blank or line feed."""
        found = []
        for at in range(0, len(words), 64 * TOGETHER):
            groups = [words[i : i + TOGETHER] for i in range(at, min(at + 64 * TOGETHER, len(words)), TOGETHER)]
            for group, ids in zip(groups, self._library_ids([LEADS[kind] + LEADS[kind].join(g) for g in groups]), strict=True):
                starts = np.flatnonzero(self._starts[kind][np.frombuffer(ids, np.uint32)]) << 2
                if len(starts) == len(group):
                    cuts = [*starts.tolist(), len(ids)]
                    found += [ids[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
                else:
                    found += self._library_ids([LEADS[kind] + w for w in group])
        return found

    def _chunk_ids(self, kind: int, words: list[str], solid: list[bool]) -> list[bytes]:
        """Ids of distinct chunks of one kind, ``solid`` those without white space."""
        if kind == FIRST:  # behind a line feed, whose id goes; what isn't solid by itself
            ids = iter(self._chunk_ids(LINE, [w for w, s in zip(words, solid, strict=True) if s], [True] * sum(solid)))
            alone = iter(self._library_ids([w for w, s in zip(words, solid, strict=True) if not s]))
            return [next(ids)[4:] if s else next(alone) for s in solid]
        young, old = self._known[kind]
        if len(young) > MEMORY // 2:
            young, old = self._known[kind] = {}, young
        found = list(map(young.get, words))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if old:
            for i, ids in zip(missing, map(old.get, [words[i] for i in missing]), strict=True):
                found[i] = ids
            young.update((words[i], found[i]) for i in missing if found[i] is not None)
            missing = [i for i in missing if found[i] is None]
        together = [i for i in missing if solid[i] and kind != AFTER_SPECIAL]
        alone = [i for i in missing if not solid[i] or kind == AFTER_SPECIAL]
        for i, ids in zip(together, self._together(kind, [words[i] for i in together]), strict=True):
            found[i] = ids
        for i, ids in zip(alone, self._library_ids([LEADS[kind] + words[i] for i in alone]), strict=True):
            found[i] = ids
        young.update((words[i], found[i]) for i in missing if len(words[i]) <= LONGEST)
        return found

    def _assembled(self, words: pa.Array, kinds: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
        """Ids of texts whose chunks follow one another, ``counts`` of each."""
        if not len(words):
            return [np.zeros(0, np.uint32)] * len(counts)
        coded = words.dictionary_encode()
        distinct = coded.dictionary
        solid = pc.invert(pc.match_substring_regex(distinct, rf"^$|{_SPACES}")).to_numpy(zero_copy_only=False)
        # chunks are numbered by kind and then by word
        at = kinds * len(distinct) + coded.indices.to_numpy(zero_copy_only=False)
        used = np.zeros(len(distinct) * len(LEADS), bool)
        used[at] = True
        blobs = []
        for kind, own in enumerate(used.reshape(len(LEADS), -1)):
            which = np.flatnonzero(own)
            if len(which):
                blobs += self._chunk_ids(kind, distinct.take(which).to_numpy(zero_copy_only=False).tolist(), solid[which].tolist())
        lengths = np.fromiter(map(len, blobs), np.int32, len(blobs)) >> 2
        pool = np.frombuffer(b"".join(blobs), np.uint32)
        ids, ends = ragged_take(pool, np.cumsum(lengths) - lengths, lengths, (np.cumsum(used, dtype=np.int32) - 1)[at])
        last = np.cumsum(counts)
        stops = np.concatenate([[0], ends])[last].tolist()
        return [ids[a:b] for a, b in zip([0, *stops], stops, strict=False)]

    def _plain(self, texts: pa.Array) -> list[np.ndarray]:
        lines = pc.split_pattern(texts, "\n")
        of_line = pc.split_pattern(lines.flatten(), " ")
        per_line = pc.list_value_length(of_line).to_numpy(zero_copy_only=False).astype(np.int64)
        lines_of = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
        words = of_line.flatten()
        kinds = np.full(len(words), BLANK, np.int32)
        starts = np.cumsum(per_line) - per_line
        kinds[starts] = LINE
        first = np.cumsum(lines_of) - lines_of
        kinds[starts[first]] = FIRST
        return self._assembled(words, kinds, np.add.reduceat(per_line, first) if len(first) else per_line)

    def _odd(self, texts: list[str]) -> list[np.ndarray]:
        words, kinds, counts = [], [], []
        for text in texts:
            before = len(words)
            for n, part in enumerate(text.split(SPECIAL)):
                cut = _CUT.split(part)
                words += cut[::2]
                kinds.append(AFTER_SPECIAL if n else FIRST)
                kinds += [BLANK if x == " " else LINE for x in cut[1::2]]
            counts.append(len(words) - before)
        return self._assembled(pa.array(words, pa.large_string()), np.array(kinds, np.int32), np.array(counts, np.int64))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text of an Arrow array (null: empty), as unsigned 32-bit numbers."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(texts, _ODD)
        if not pc.any(odd).as_py():
            return self._plain(texts)
        plain, rest = self._plain(texts.filter(pc.invert(odd))), self._odd(texts.filter(odd).to_pylist())
        of = [iter(plain), iter(rest)]
        return [next(of[o]) for o in odd.to_pylist()]


@functools.lru_cache(maxsize=4)
def token_ids(path: str) -> TokenIds:
    """One memory for all tasks that a Python worker runs."""
    return TokenIds(path)
