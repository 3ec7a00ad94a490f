"""Token ids in files that a grammar compresses (Re-Pair), with random access.

A shard holds the ids of consecutive documents. In each round its frequent neighbouring pairs
are counted and replaced by new symbols (nonterminals), the more frequent pair first where two
overlap; no pair spans two documents. A file has the rules, how many ids each symbol stands
for, and the symbols that are left, with the document ends among them: any part of a
document can be read by adding up lengths, without expanding what is before it.

Documents are put in ascending order of their ids by a range shuffle, so that a task writes
consecutive documents and the shards follow one another. Shards are closed at a stated number
of ids and are written under a name of their own attempt; the table of the shards, which Spark
commits, names those that count.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marlstone.llm.common import ids_and_texts, make_dir
from marlstone.llm.token_ids import ragged_take, slices, token_ids

MAGIC = b"RPGRAM01"
_BUCKETS = 1 << 18


def _buckets(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    mixed = left.astype(np.uint32) * np.uint32(2654435761) ^ right.astype(np.uint32) * np.uint32(2246822519)
    return (mixed ^ mixed >> np.uint32(15)) & np.uint32(_BUCKETS - 1)


class Grammar:
    """Rules by round, the length of every symbol's expansion, and the symbols of documents."""

    def __init__(self, base: int, rounds: list[np.ndarray], symbols: np.ndarray, ends: np.ndarray):
        self.base, self.rounds, self.symbols, self.ends = base, rounds, symbols, ends
        lengths = np.ones(base, np.int64)
        for rules in rounds:
            lengths = np.concatenate([lengths, lengths[rules[:, 0]] + lengths[rules[:, 1]]])
        self.lengths = lengths

    @classmethod
    def of(cls, ids: np.ndarray, ends: np.ndarray, base: int, rounds: int = 8, least: int = 16) -> Grammar:
        """Compresses ids; a document's part ends at each of ``ends``. Stops after ``rounds``
        or when no pair is met ``least`` times."""
        symbols, made = ids.astype(np.int32), []
        last = np.zeros(len(ids), bool)
        last[ends[ends > 0] - 1] = True
        top = base
        for _ in range(rounds):
            if len(symbols) < 2 * least:
                break
            rules, at, rule = cls._round(symbols, last, least)
            if not len(rules):
                break
            symbols[at] = top + rule
            last[at] = last[at + 1]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            symbols, last = symbols[keep], last[keep]
            made.append(rules)
            top += len(rules)
        # empty parts end where the one before them does
        kept = np.concatenate([[0], np.flatnonzero(last) + 1])
        full = np.diff(np.concatenate([[0], ends])) > 0
        return cls(base, made, symbols, kept[np.cumsum(full)])

    @staticmethod
    def _round(symbols: np.ndarray, last: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pairs that are replaced, and at which places which of them is."""
        none = np.zeros((0, 2), np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        bucket = _buckets(symbols[:-1], symbols[1:])
        # a pair is met at most as often as its bucket, so most rare pairs are never looked at
        often = np.bincount(bucket, minlength=_BUCKETS) >= least
        at = np.flatnonzero(often[bucket] & ~last[:-1])
        keys = symbols[at].astype(np.int64) << 32 | symbols[at + 1]
        ordered = np.sort(keys)
        if not len(ordered):
            return none
        starts = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
        counts = np.diff(np.concatenate([starts, [len(ordered)]]))
        pairs, counts = ordered[starts][counts >= least], counts[counts >= least]
        if not len(pairs):
            return none
        by_count = np.argsort(-counts, kind="stable")
        pairs = pairs[by_count]
        # of pairs that share a bucket the most frequent has it in this round
        place = np.full(_BUCKETS, -1, np.int32)
        of_pair = _buckets(pairs >> 32, pairs & 0xFFFFFFFF)
        place[of_pair[::-1]] = np.arange(len(pairs))[::-1]
        rank = place[bucket[at]]
        met = (rank >= 0) & (pairs[rank] == keys)
        at, rank = at[met], rank[met]
        # of overlapping pairs the one of least rank; in a run of one symbol every second
        beside = np.diff(at) == 1
        fits = np.ones(len(at), bool)
        fits[1:] &= ~beside | (rank[1:] <= rank[:-1])
        fits[:-1] &= ~beside | (rank[:-1] <= rank[1:])
        at, rank = at[fits], rank[fits]
        index = np.arange(len(at))
        run = np.maximum.accumulate(np.where(np.diff(at, prepend=-2) != 1, index, 0))
        odd = (index - run) % 2 == 0
        at, rank = at[odd], rank[odd]
        used = np.bincount(rank, minlength=len(pairs)) >= 2
        number = np.cumsum(used) - 1
        keep = used[rank]
        pairs = pairs[used]
        return np.stack([pairs >> 32, pairs & 0xFFFFFFFF], axis=1).astype(np.int32), at[keep], number[rank[keep]]

    def _expansions(self) -> tuple[np.ndarray, np.ndarray]:
        """All symbols' expansions one behind the other, and where each starts."""
        pool, starts = np.arange(self.base, dtype=np.uint32), np.cumsum(self.lengths) - self.lengths
        for rules in self.rounds:
            pool = np.concatenate([pool, ragged_take(pool, starts, self.lengths, rules.ravel())[0]])
        return pool, starts

    def documents(self, most_ids: int = 1 << 21) -> Iterator[list[np.ndarray]]:
        """The ids of the documents, in blocks of about ``most_ids``."""
        pool, starts = self._expansions()
        sizes = np.concatenate([[0], np.cumsum(self.lengths[self.symbols])])[self.ends]
        first = 0
        while first < len(self.ends):
            begin = sizes[first - 1] if first else 0
            stop = max(first + 1, int(np.searchsorted(sizes, begin + most_ids, "right")))
            ids, _ = ragged_take(pool, starts, self.lengths, self.symbols[self.ends[first - 1] if first else 0 : self.ends[stop - 1]])
            cuts = (sizes[first:stop] - begin).tolist()
            yield [ids[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]
            first = stop

    def part(self, document: int, start: int, stop: int) -> np.ndarray:
        """ids[start:stop] of a document: only symbols that reach into it are expanded."""
        symbols = self.symbols[self.ends[document - 1] if document else 0 : self.ends[document]]
        ends = np.cumsum(self.lengths[symbols])
        first, last = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left")
        begin = ends[first - 1] if first else 0
        ids = self._expanded(symbols[first : last + 1])
        return ids[max(start, 0) - begin : max(stop, 0) - begin]

    def _expanded(self, symbols: np.ndarray) -> np.ndarray:
        """Ids of a few symbols, by their own rules alone."""
        rules = np.concatenate([np.zeros((0, 2), np.int32), *self.rounds])
        while (new := symbols >= self.base).any():
            width = 1 + new
            at = np.cumsum(width) - width
            wider = np.empty(int(width.sum()), symbols.dtype)
            wider[at] = np.where(new, rules[np.where(new, symbols - self.base, 0), 0] if len(rules) else symbols, symbols)
            wider[at[new] + 1] = rules[symbols[new] - self.base, 1]
            symbols = wider
        return symbols.astype(np.uint32)

    def write(self, stream: BinaryIO, doc_ids: list) -> None:
        """A head in JSON (its size first), then the arrays it names, little-endian."""
        narrow = "<u2" if self.base + sum(map(len, self.rounds)) <= 1 << 16 else "<u4"
        arrays = {
            "doc_id": np.array([0 if x is None else x for x in doc_ids], "<i8"), "null": np.packbits([x is None for x in doc_ids]), "end": self.ends.astype("<u8"),
            "rule": np.concatenate([np.zeros((0, 2), np.int32), *self.rounds]).astype("<u4"), "length": self.lengths[self.base :].astype("<u4"), "symbol": self.symbols.astype(narrow),
        }
        head = json.dumps({"base": self.base, "documents": len(doc_ids), "rounds": list(map(len, self.rounds)), "arrays": [[n, a.dtype.str, a.size] for n, a in arrays.items()]}).encode()
        stream.write(MAGIC + struct.pack("<I", len(head)) + head)
        for a in arrays.values():
            stream.write(a.tobytes())

    @classmethod
    def read(cls, stream: BinaryIO) -> tuple[Grammar, list]:
        """A shard and the ids of its documents."""
        if stream.read(len(MAGIC)) != MAGIC:
            raise ValueError("not a shard of token ids")
        head = json.loads(stream.read(struct.unpack("<I", stream.read(4))[0]))
        arrays = {}
        for name, kind, size in head["arrays"]:
            data = stream.read(size * np.dtype(kind).itemsize)
            arrays[name] = np.frombuffer(data, kind)
            if len(arrays[name]) != size:
                raise ValueError("a shard of token ids breaks off")
        rounds = np.split(arrays["rule"].reshape(-1, 2).astype(np.int32), np.cumsum(head["rounds"])[:-1]) if head["rounds"] else []
        grammar = cls(head["base"], rounds, arrays["symbol"].astype(np.int32), arrays["end"].astype(np.int64))
        if (grammar.lengths[grammar.base :] != arrays["length"]).any():
            raise ValueError("a shard's rules and lengths don't agree")
        null = np.unpackbits(arrays["null"], count=head["documents"]).astype(bool)
        return grammar, [None if n else i for i, n in zip(arrays["doc_id"].tolist(), null.tolist(), strict=True)]


def _stream(path: str, mode: str) -> BinaryIO:
    """A file of the shared folder, local or of a store that pyarrow knows."""
    if path.startswith("file:") or "://" not in path:
        return open("/" + path.removeprefix("file:").lstrip("/"), mode)
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    return system.open_output_stream(inner) if mode == "wb" else system.open_input_file(inner)


SHARDS = "part int, shard int, path string, documents bigint, tokens bigint"


def write(docs: DataFrame, tokenizer_path: str, path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, shard_ids: int = 1 << 19, rounds: int = 4, least: int = 16) -> DataFrame:
    """Writes the ids of ``docs`` below ``path``, a new folder that all executors share: the
    shards, and their table, which is returned.

    A document's ids are those of its whole text (null: empty) and then ``end_id``. Documents
    go by ascending id, nulls first, those of one id by a hash of their text; repeated rows
    are documents each. An empty table gives no shards. Further columns are ignored. A
    document is never parted, so a shard has at most ``shard_ids`` ids and one document more.
    """
    spark = docs.sparkSession
    make_dir(spark, f"{path}/shards")
    rows = ids_and_texts(docs, id_col, text_col).withColumns({"doc_id": F.col("doc_id").cast("bigint"), "h": F.xxhash64("text")})
    rows = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, task = token_ids(tokenizer_path), TaskContext.get()
        end = np.array([end_id], np.uint32)
        own, number = f"{task.partitionId():06d}-{uuid.uuid4().hex}", 0
        doc_ids, parts, held = [], [], 0

        def closed() -> pa.RecordBatch:
            nonlocal doc_ids, parts, held, number
            name = f"{path}/shards/{own}-{number:06d}.rp"
            ends = np.cumsum([len(p) for p in parts])
            ids = np.concatenate(parts)
            with _stream(name, "wb") as stream:
                Grammar.of(ids, ends, max(encoder.size, end_id + 1), rounds, least).write(stream, doc_ids)
            row = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((task.partitionId(), pa.int32()), (number, pa.int32()), (name, pa.string()), (len(doc_ids), pa.int64()), (len(ids), pa.int64()))], names=["part", "shard", "path", "documents", "tokens"])
            doc_ids, parts, held, number = [], [], 0, number + 1
            return row

        for batch in slices(batches, "text"):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder.encode(batch.column(1)), strict=True):
                doc_ids.append(doc_id)
                parts.append(np.concatenate([ids, end]))
                held += len(ids) + 1
                if held >= shard_ids:
                    yield closed()
        if doc_ids:
            yield closed()

    rows.mapInArrow(run, SHARDS).write.parquet(f"{path}/table")
    return spark.read.schema(SHARDS).parquet(f"{path}/table")


def read(spark: SparkSession, path: str, task_ids: int = 1 << 22) -> DataFrame:
    """A row per document of the files: doc_id, start (ids of all documents before it),
    n_tokens, ids_crc32. The driver sees one total per writing task; a task reads shards of
    about ``task_ids`` ids."""
    table = spark.read.schema(SHARDS).parquet(f"{path}/table")
    before, totals = 0, []
    for r in table.groupBy("part").agg(F.sum("tokens").alias("n")).orderBy("part").collect():
        totals.append((r.part, before))
        before += r.n
    offsets = spark.createDataFrame(totals, "part int, before bigint")
    ahead = F.sum("tokens").over(Window.partitionBy("part").orderBy("shard")) - F.col("tokens")
    shards = table.withColumn("ahead", ahead).join(F.broadcast(offsets), "part").select("path", (F.col("before") + F.col("ahead")).alias("start"))
    # rows this small would be coalesced into one task; a stated number of partitions is not
    shards = shards.repartition(max(spark.sparkContext.defaultParallelism, before // task_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with _stream(name, "rb") as stream:
                    grammar, doc_ids = Grammar.read(stream)
                at = 0
                for block in grammar.documents():
                    sizes = np.array([len(x) for x in block], np.int64)
                    starts = start + np.cumsum(sizes) - sizes
                    crc = [zlib.crc32(x.astype("<u4", copy=False)) for x in block]
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids[at : at + len(block)], pa.int64()), pa.array(starts), pa.array(sizes), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])
                    at, start = at + len(block), start + int(sizes.sum())

    return shards.mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
