"""Harmonic packing of tokenised documents into fixed-capacity sequences.

Every worker (a partition) packs its own documents in one pass, with no shuffle and no
word to the others. Pieces fall into reciprocal-capacity classes: class k holds lengths in
(capacity / (k + 1), capacity / k], and a bin of class k is closed at exactly k pieces. As
documents may be cut freely, each is cut to lengths capacity, capacity / 2, ... down to
``least``, which fill the bins of their classes without padding; the rest (shorter than
``least``) is one piece of a class of at least capacity / least, whose bins waste at most
1 / (capacity / least + 1). What a worker has in open bins at its end is bounded by the
classes, not the data; it is laid out end to end, cut at the capacity, and the tail is cut
into powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from marlstone.llm.common import ids_and_texts, map_arrow
from marlstone.llm.token_ids import slices, token_ids

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
FIELDS = [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64())]


class Packer:
    """One worker's bins. A piece is (doc_id, start, id bytes, doc_tokens); rows are lists
    of columns as in FIELDS, with the ids themselves as a last column if wanted."""

    def __init__(self, worker: int, capacity: int, least: int, with_ids: bool):
        if capacity & (capacity - 1) or least & (least - 1) or not 1 <= least <= capacity:
            raise ValueError("capacity and least are powers of two, least not above capacity")
        self.next_id, self.capacity, self.least, self.with_ids = worker << 40, capacity, least, with_ids
        self.open: dict[int, list] = {}
        self.rows: list[list] = [[] for _ in range(len(FIELDS) + with_ids)]

    def _close(self, pieces: list) -> None:
        at, rows = 0, self.rows
        for doc_id, start, ids, total in pieces:
            n = len(ids) >> 2
            values = (doc_id, start, n, zlib.crc32(ids), total, self.next_id, at)
            for column, value in zip(rows, values, strict=False):
                column.append(value)
            if self.with_ids:
                rows[-1].append(list(memoryview(ids).cast("I")))
            at += n
        self.next_id += 1

    def _place(self, n: int, piece: tuple) -> None:
        count = self.capacity // n
        bin_ = self.open.setdefault(count, [])
        bin_.append(piece)
        if len(bin_) == count:
            self._close(self.open.pop(count))

    def add(self, doc_id, ids: bytes) -> None:
        total = len(ids) >> 2
        start, size = 0, self.capacity
        while total - start >= self.least:
            while size > total - start:
                size >>= 1
            self._place(size, (doc_id, start, ids[4 * start : 4 * (start + size)], total))
            start += size
        if start < total:
            self._place(total - start, (doc_id, start, ids[4 * start :], total))

    def finish(self) -> None:
        left = [piece for count in sorted(self.open) for piece in self.open[count]]
        self.open = {}
        rest = sum(len(p[2]) >> 2 for p in left)
        room, sequence = 0, []
        for doc_id, start, ids, total in left:
            while ids:
                if not room:
                    room = self.capacity if rest >= self.capacity else 1 << (rest.bit_length() - 1)
                part = ids[: 4 * room]
                n = len(part) >> 2
                sequence.append((doc_id, start, part, total))
                ids, start, room, rest = ids[4 * n :], start + n, room - n, rest - n
                if not room:
                    self._close(sequence)
                    sequence = []

    def taken(self) -> list[list]:
        out, self.rows = self.rows, [[] for _ in self.rows]
        return out


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 2048, end_id: int = 1, least: int = 64, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    and with ``with_ids`` the piece's ids.

    A document's ids are the tokenizers library's of its whole text and then ``end_id``; a
    null or empty text is ``end_id`` alone. Rows are documents: repeated rows are packed
    each, a null doc_id stays null. An empty table gives no rows. Further columns are
    ignored. Sequence ids are unique within one result.
    """
    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    fields = FIELDS + ([("ids", pa.list_(pa.int32()))] if with_ids else [])
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = token_ids(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId(), capacity, least, with_ids)

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(packer.taken(), fields, strict=True)], names=[n for n, _ in fields])

        for batch in slices(batches, "text"):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                packer.add(doc_id, ids.tobytes() + end)
            yield out()
        packer.finish()
        yield out()

    return map_arrow(ids_and_texts(docs, id_col, text_col), run, schema)
