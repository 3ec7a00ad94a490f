"""SentencePiece encoding and decoding over a relational lattice.

Texts fall into units that no piece of the vocabulary reaches across. A unit's substrings of
bounded length are exploded and joined to the piece table, the edges found are grouped by
unit, and a fold (Spark's aggregate) over them gives the segmentation. A filter of hashes
(Spots) goes before: substrings that are no piece for certain are not exploded. For a unigram
vocabulary the fold is Viterbi's. For a merge vocabulary, which the score sum does not
describe, it applies the best edge that joins two neighbouring symbols until none does; that
is what the library does with such a model.

All of it is one pass without a shuffle: a task sends the units that are new to it ahead of
the texts that hold them, explode and the broadcast join keep that order, so the edges of a
unit arrive side by side and its pieces before its texts. A task remembers a bounded number
of units and starts anew beyond it. Units of more than MASK characters (runs of letters or
signs) come in overlapping stretches, so that their substrings cost no more than others, and
their edges are folded where they are grouped, in n log n.
"""

from __future__ import annotations

import functools
import heapq
import json
import re
import struct
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import ids_and_texts, map_arrow, slices

BLANK = "▁"
LETTERS = r"[^\W\d_²³¹]+"
UNIT = re.compile(rf"{BLANK}*(?:{LETTERS}|(?:[^\w{BLANK}]|[_²³¹])+|\d)|{BLANK}+")
#: The fold's state is a 64-bit mask up to this unit length; longer units come in stretches
#: of STRETCH starts each.
MASK, STRETCH = 60, 256
#: Set in that mask when the order of merges has to be looked at again.
AGAIN = 1 << 62
_PLACE = (1 << 20) - 1
#: In place of an edge: the row of a unit itself.
HEAD = -1
#: Units that a task remembers.
REMEMBERED = 600_000


# Numbers of fields and of model kinds in a model file.
TRAINER, MODEL_TYPE, UNIGRAM, MERGES = 2, 3, 1, 2


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a message's fields (whole numbers and byte strings)."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        wire = key & 7
        if wire == 0:
            yield key >> 3, number()
        else:
            size = number() if wire == 2 else 8 if wire == 1 else 4
            yield key >> 3, data[at : at + size]
            at += size


def model_kind(data: bytes) -> int:
    trainer = next((v for n, v in _fields(data) if n == TRAINER), b"")
    return next((v for n, v in _fields(trainer) if n == MODEL_TYPE), UNIGRAM)


@dataclass(frozen=True)
class Model:
    """pieces: (piece, score, id) of the ordinary ones; first_byte: id of the piece of byte
    0, the others follow; merges: whether scores are merge ranks."""

    pieces: tuple[tuple[str, float, int], ...]
    first_byte: int
    unknown: int
    merges: bool = True

    @classmethod
    def load(cls, path: str) -> Model:
        """Reads a model file of either kind; what the file says decides between them."""
        import sentencepiece

        with open(path, "rb") as f:
            kind = model_kind(f.read())
        if kind not in (UNIGRAM, MERGES):
            raise ValueError(f"{path} is neither a unigram nor a merge vocabulary")

        lib = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(lib.get_piece_size())
        plain = tuple((lib.id_to_piece(i), lib.get_score(i), i) for i in ids if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)))
        if across := [p for p, _, _ in plain if len(UNIT.findall(p)) != 1]:
            raise ValueError(f"pieces reach across units: {across[:5]}")
        return cls(plain, next((i for i in ids if lib.is_byte(i)), -1), lib.unk_id(), kind == MERGES)

    def longest(self) -> int:
        return max(len(p) for p, _, _ in self.pieces)

    def least(self) -> int:
        """The length of the shortest edge: merges join two characters at least."""
        return 2 if self.merges else 1

    def joined(self) -> list[str]:
        """The pieces that may be edges."""
        return [p for p, _, _ in self.pieces if len(p) >= self.least()]


#: Kinds of characters; others are signs.
_SPACE, _LETTER, _DIGIT, _SIGN = range(4)


@functools.cache
def _kinds() -> np.ndarray:
    """The kind of each code point, as UNIT has them."""
    every = "".join(map(chr, range(0x110000)))
    kinds = np.full(len(every), _SIGN, np.uint8)
    for pattern, kind in ((LETTERS, _LETTER), (r"\d+", _DIGIT), (" ", _SPACE)):
        for m in re.finditer(pattern, every):
            kinds[m.start() : m.end()] = kind
    return kinds


def units_of(texts: list[str | None]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The units of texts (with the blank that goes before each) in order, with spaces for
    blanks, and how many each text has. They are what UNIT finds."""
    spaced = [" " + t.replace(BLANK, " ") if t else "" for t in texts]
    whole = "".join(spaced)
    points, data = np.frombuffer(whole.encode("utf-32-le"), "<u4"), whole.encode()
    kinds = _kinds()[points]
    begins = np.ones(len(points), bool)
    begins[1:] = (kinds[:-1] != _SPACE) & ((kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT))
    sizes = np.fromiter(map(len, spaced), np.int64, len(spaced))
    at = np.cumsum(sizes) - sizes
    begins[at[sizes > 0]] = True
    starts = np.flatnonzero(begins)
    counts = np.diff(starts.searchsorted(np.append(at, len(points))))
    offsets = np.append(starts, len(points))
    if len(data) != len(points):
        more = (points > 0x7F).astype(np.uint8)
        more += points > 0x7FF
        more += points > 0xFFFF
        offsets[1:] += np.cumsum(more, dtype=np.int64)[offsets[1:] - 1]
    found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
    return found.dictionary_encode(), counts


#: A row is a unit, a stretch of one (place: where it is) or, without a unit, a text with its
#: numbers (place: all of it, packed). Edges travel with every column, so these are few.
_UNITS = "unit string, place binary, spots array<bigint>"


def _packed(doc_id: int | None, text: str | None, numbers: bytes) -> bytes:
    return struct.pack("<?q?q", doc_id is not None, doc_id or 0, text is not None, len(numbers)) + numbers + (text or "").encode()


def _unpacked(row: bytes) -> tuple[int | None, str | None, bytes]:
    has_id, doc_id, has_text, size = struct.unpack_from("<?q?q", row)
    at = struct.calcsize("<?q?q")
    return doc_id if has_id else None, row[at + size :].decode() if has_text else None, row[at : at + size]


class Spots:
    """Where a unit's substrings may be pieces: start and length, as start << 20 | length.

    One byte for each hash says whether a piece has it (1) and whether a beginning of a longer
    piece has it (2). Every piece is found; a few other substrings are too, which the join drops.
    """

    BITS = 21

    def __init__(self, pieces: list[str]):
        self.seen = np.zeros(1 << self.BITS, np.uint8)
        points, left, at = self._laid_out(pieces)
        self.longest = int(left.max(initial=0))
        sizes = left[at]
        hashes = np.zeros(len(at), np.uint64)
        for k in range(1, self.longest + 1):
            at, hashes, sizes = (x[sizes >= k] for x in (at, hashes, sizes))
            hashes = self._next(hashes, points[at + k - 1])
            np.bitwise_or.at(self.seen, self._places(hashes), np.where(sizes == k, 1, 2).astype(np.uint8))

    @staticmethod
    def _laid_out(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code points of texts end to end, how many are left of its text at each, and where texts begin."""
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        return points, np.repeat(ends, sizes) - np.arange(len(points)), ends - sizes

    @staticmethod
    def _next(hashes: np.ndarray, points: np.ndarray) -> np.ndarray:
        return (hashes ^ points) * np.uint64(0x9E3779B97F4A7C15)

    def _places(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)

    def of(self, texts: list[str]) -> pa.ListArray:
        """Spots of each text, the empty substring at its beginning first."""
        points, left, starts = self._laid_out(texts)
        at = np.arange(len(points))
        hashes = np.zeros(len(points), np.uint64)
        found = [at[:0]]
        for k in range(1, self.longest + 1):
            if not len(at):
                break
            hashes = self._next(hashes, points[at + k - 1])
            seen = self.seen[self._places(hashes)]
            found.append((at[seen & 1 > 0] << 20) + k)
            more = (seen & 2 > 0) & (left[at] > k)
            at, hashes = at[more], hashes[more]
        spots = np.concatenate(found)
        spots.sort()
        # an empty text begins where the next one does, so heads go in by counts
        counts = np.diff(spots.searchsorted(np.append(starts, len(points)) << 20)) + 1
        offsets = np.concatenate([[0], np.cumsum(counts)])
        listed = np.zeros(len(spots) + len(texts), np.int64)
        inner = np.ones(len(listed), bool)
        inner[offsets[:-1]] = False
        listed[inner] = spots - np.repeat(starts << 20, counts - 1)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(listed))


def spotted(batches: Iterator[pa.RecordBatch], pieces: list[str]) -> Iterator[pa.RecordBatch]:
    """Rows with the spots of their units."""
    filter_ = Spots(pieces)
    for batch in batches:
        yield batch.append_column("spots", filter_.of([u or "" for u in batch.column("unit").to_pylist()]))


def _parts(units: list[str], longest: int, most: int = 10_000) -> Iterator[tuple[list[str], pa.Array]]:
    """Units in batches, the long ones as stretches, and the place of each stretch."""
    for first in range(0, len(units), most):
        some = units[first : first + most]
        if max(map(len, some)) <= MASK:
            yield some, pa.nulls(len(some), pa.binary())
            continue
        parts = [x for u in some for x in ([(u, None)] if len(u) <= MASK else stretches(u, longest))]
        for at in range(0, len(parts), most):
            names, places = zip(*parts[at : at + most], strict=True)
            yield list(names), pa.array(places, pa.binary())


class _Numbers(dict):
    """Numbers of units, from 0 as they come; new ones are noted."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, unit: str) -> int:
        n = self[unit] = len(self)
        self.new.append(unit)
        return n


def stretches(unit: str, longest: int) -> list[tuple[str, bytes]]:
    """A long unit's stretches, each with where it starts and the unit's length; they overlap
    by what a piece from the last start of one may need."""
    return [(unit[i : i + STRETCH + longest], struct.pack("<qq", i, len(unit))) for i in range(0, len(unit), STRETCH)]


def numbered(batches: Iterator[pa.RecordBatch], pieces: list[str], longest: int, remembered: int = REMEMBERED) -> Iterator[pa.RecordBatch]:
    """Units not sent before, numbered from 0 as they come, then the texts (without a unit)
    that hold them, each with the count of units so far and the numbers of its own in order
    (32 bits each). The empty unit says that all before it is forgotten and numbers start
    anew. Long units come as stretches. Spots are those of ``pieces``."""
    units, filter_ = _Numbers(), Spots(pieces)
    for batch in slices(batches, "text", 2 << 20):
        new: list[str] = []
        if len(units) > remembered:
            units.clear()
            new.append("")
        texts = batch.column(1).to_pylist()
        found, counts = units_of(texts)
        own = np.fromiter(map(units.__getitem__, found.dictionary.to_numpy(zero_copy_only=False).tolist()), np.int32, len(found.dictionary))[found.indices.to_numpy()].tobytes()
        new += [u.replace(" ", BLANK) for u in units.new]
        units.new.clear()
        for names, places in _parts(new, longest):
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), places, filter_.of(names)], names=["unit", "place", "spots"])
        count, ends = array("i", [len(units)]).tobytes(), (4 * np.cumsum(counts)).tolist()
        rows = [_packed(i, t, count + own[a:b]) for i, t, a, b in zip(batch.column(0).to_pylist(), texts, [0, *ends], ends, strict=False)]
        yield pa.RecordBatch.from_arrays([pa.nulls(len(rows), pa.string()), pa.array(rows, pa.binary()), filter_.of([""] * len(rows))], names=["unit", "place", "spots"])


def _side_by_side(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.ListArray]]:
    """Groups rows that stand side by side: a row with HEAD for an edge begins a unit, its
    edges follow. Heads come out as rows, with the edges of each, sorted."""
    rest = None
    for batch in batches:
        got = pa.Table.from_batches([batch])
        if rest is not None:
            got = pa.concat_tables([rest, got])
        heads = np.flatnonzero(got.column("edge").to_numpy() == HEAD)
        if len(heads) > 1:
            yield _group(got.slice(0, heads[-1]), heads[:-1])
            got = got.slice(heads[-1])
        rest = got
    if rest is not None and rest.num_rows:
        yield _group(rest, np.array([0]))


def grouped(batches: Iterator[pa.RecordBatch], costs: list[float], merges: bool) -> Iterator[pa.RecordBatch]:
    """Units and texts with the edges of each, side by side, as masks of their two ends for
    a merge vocabulary; the stretches of a long unit become one row again, with its cuts."""
    held: list[tuple[str, int, np.ndarray]] = []
    for batch, edges in _side_by_side(batches):
        long = (pc.utf8_length(batch.column("unit")).fill_null(0).to_numpy() > MASK)
        if "place" in batch.schema.names:  # stretches have one, of which the last may be short
            long |= pc.and_(batch.column("unit").is_valid(), batch.column("place").is_valid()).to_numpy(zero_copy_only=False)
        sent = pa.ListArray.from_arrays(edges.offsets, pa.array(_ends(edges.values.to_numpy()))) if merges else edges
        turns = np.flatnonzero(np.diff(long)) + 1
        for first, last in zip([0, *turns], [*turns, batch.num_rows], strict=True):
            some = batch.slice(first, last - first)
            if last > first and not long[first]:
                yield some.append_column("edges", sent.slice(first, last - first)).append_column("cuts", pa.nulls(some.num_rows, pa.list_(pa.int32())))
                continue
            for i, unit in enumerate(some.column("unit").to_pylist()):
                at, size = struct.unpack("<qq", some.column("place")[i].as_py()) if "place" in some.schema.names else (0, 0)
                held.append((unit if not size else unit[:STRETCH], at, edges[first + i].values.to_numpy()))
                if at + STRETCH >= size:
                    yield _long(some.slice(i, 1), held, costs, merges)
                    held = []


def _ends(edges: np.ndarray) -> np.ndarray:
    """Masks of edges' two ends, 0 beyond MASK."""
    s, e = (edges >> 20) & _PLACE, edges & _PLACE
    return np.where(e <= MASK, (1 << np.minimum(s, MASK)) + (1 << np.minimum(e, MASK)), 0)


def _long(row: pa.RecordBatch, held: list[tuple[str, int, np.ndarray]], costs: list[float], merges: bool) -> pa.RecordBatch:
    """The last stretch's row for the whole unit, with its cuts in place of edges."""
    unit = "".join(u for u, _, _ in held)
    edges = np.unique(np.concatenate([np.c_[e >> 40, (e >> 20 & _PLACE) + at, (e & _PLACE) + at] for _, at, e in held]), axis=0)
    cuts = merged(*edges.T, len(unit)) if merges else cheapest(*edges.T, len(unit), costs)
    columns = [pa.array([unit], f.type) if f.name == "unit" else row.column(f.name) for f in row.schema]
    return pa.RecordBatch.from_arrays([*columns, pa.array([[]], pa.list_(pa.int64())), pa.array([cuts], pa.list_(pa.int32()))], names=[*row.schema.names, "edges", "cuts"])


def merged(place: np.ndarray, start: np.ndarray, end: np.ndarray, size: int) -> list[int]:
    """Cuts of a unit: of the edges that join two neighbouring symbols the best is applied,
    the first of equals, until there is none. A heap has the candidates."""
    order = np.lexsort((end, start))
    keys, places = (start * (size + 1) + end)[order], place[order].tolist()
    ends, before = [*range(1, size + 1)], [*range(-1, size)]  # of the symbol that starts here
    pairs = end - start == 2
    heap = list(zip(place[pairs].tolist(), start[pairs].tolist(), end[pairs].tolist(), strict=True))
    heapq.heapify(heap)

    def offer(a: int, b: int) -> None:
        key = a * (size + 1) + b
        i = int(keys.searchsorted(key))
        if i < len(places) and keys[i] == key:
            heapq.heappush(heap, (places[i], a, b))

    while heap:
        _, a, b = heapq.heappop(heap)
        middle = ends[a]
        if middle <= a or middle >= b or ends[middle] != b:
            continue
        ends[a], ends[middle] = b, -1
        if b < size:
            before[b] = a
            offer(a, ends[b])
        if before[a] >= 0:
            offer(before[a], b)
    cuts = [0]
    while cuts[-1] < size:
        cuts.append(ends[cuts[-1]])
    return cuts


def cheapest(place: np.ndarray, start: np.ndarray, end: np.ndarray, size: int, costs: list[float]) -> list[int]:
    """Cuts of a unit: Viterbi over the edges, as _viterbi_cuts."""
    worst = _worst(costs)
    ways: dict[int, list[tuple[int, float]]] = {}
    for p, a, b in zip(place.tolist(), start.tolist(), end.tolist(), strict=True):
        ways.setdefault(b, []).append((a, costs[p]))
    cost, back = [0.0], [-1]
    for e in range(1, size + 1):
        best = min([(cost[e - 1] + worst, e - 1), *((cost[a] + c, a) for a, c in ways.get(e, ()))])
        cost.append(best[0])
        back.append(best[1])
    cuts = [size]
    while cuts[-1] > 0:
        cuts.append(back[cuts[-1]])
    return cuts[::-1]


def _worst(costs: list[float]) -> float:
    """Of a character without an edge: more than any path of pieces."""
    return max(1e6, 1e3 * max(map(abs, costs), default=1.0))


def _group(rows: pa.Table, heads: np.ndarray) -> tuple[pa.RecordBatch, pa.ListArray]:
    n = rows.num_rows
    edge = rows.column("edge").to_numpy()
    unit = np.zeros(n, np.int64)
    unit[heads] = 1
    unit = np.cumsum(unit)
    has = edge != HEAD
    edge, unit = edge[has], unit[has]
    place, s, e = edge >> 40, (edge >> 20) & _PLACE, edge & _PLACE
    if len(edge) and n < 1 << 26 and place.max() < 1 << 17 and e.max() < 1 << 10:  # one number sorts faster
        packed = np.sort((unit << 37) + (place << 20) + (s << 10) + e)
        edge = ((packed >> 20 & (1 << 17) - 1) << 40) + ((packed >> 10 & 1023) << 20) + (packed & 1023)
    else:
        edge = edge[np.lexsort((edge, unit))]
    offsets = pa.array(np.append(heads, n) - np.arange(len(heads) + 1), pa.int32())
    out = rows.drop_columns(["edge"]).take(pa.array(heads)).combine_chunks()
    columns = [(c.chunk(0) if c.num_chunks else pa.array([], c.type)) for c in out.columns]
    return pa.RecordBatch.from_arrays(columns, names=out.column_names), pa.ListArray.from_arrays(offsets, pa.array(edge, pa.int64()))


def lattice(spark: SparkSession, units: DataFrame, model: Model) -> DataFrame:
    """``units`` with parts: the unit's pieces in order; characters outside the vocabulary
    are parts of their own. Rows keep their order, a null unit has no parts. Substrings of a
    unit far beyond MASK are cheap only as stretches, which encode() sends."""
    types, pieces = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in units.schema), model.joined()
    spots = map_arrow(units, lambda batches: spotted(batches, pieces), f"{types}, spots array<bigint>")
    bits = F.filter(F.sequence(F.lit(0), F.length("unit")), lambda i: F.col("mask").bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("bigint"), i)) != 0)
    listed = folded(spark, spots, model).withColumn("cuts", F.coalesce("cuts", bits))
    parts = F.transform(F.slice("cuts", 1, F.size("cuts") - 1), lambda a, i: F.substring(F.col("unit"), a + 1, F.get(F.col("cuts"), i + 1) - a))
    return listed.select(*units.columns, F.when(F.col("cuts").isNotNull(), parts).alias("parts"))


def folded(spark: SparkSession, units: DataFrame, model: Model) -> DataFrame:
    """``units`` (with spots) with where their pieces begin and end: mask (a bit each) or cuts.

    Substrings at the spots are exploded and joined to the piece table, whose size the model
    fixes; the empty substring of each unit meets an entry of its own, so no unit is lost, and
    carries the other columns. An edge is one number, its piece's place by score, then start
    and end: edges sort best first.
    """
    costs = sorted({-s for _, s, _ in model.pieces})
    place = {c: i for i, c in enumerate(costs)}
    least = model.least()
    rows = [(p, place[-s]) for p, s, _ in model.pieces if len(p) >= least] + [("", -1)]
    table = F.broadcast(spark.createDataFrame(rows, "own string, rank bigint").withColumn("hash", F.xxhash64("own")))
    others = [f for f in units.schema if f.name != "spots"]
    names = [f.name for f in others]
    spots = units.select(*names, F.explode("spots").alias("spot"))
    spots = spots.withColumn("s", F.shiftright("spot", 20).cast("int")).withColumn("k", F.col("spot").bitwiseAND(F.lit(_PLACE)).cast("int"))
    spots = spots.withColumn("piece", F.expr("coalesce(substring(unit, s + 1, k), '')"))
    edge = F.when(F.col("rank") < 0, F.lit(HEAD).cast("bigint")).otherwise(F.expr("shiftleft(rank, 40) + spot + s"))
    # a hash as the key makes the probe cheap; strings that begin with each other are equal
    equal = (F.xxhash64("piece") == F.col("hash")) & F.col("piece").startswith(F.col("own")) & F.col("own").startswith(F.col("piece"))
    whole = [F.when(F.col("rank") < 0, F.col(n)).alias(n) for n in names]
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others)
    merges = model.merges
    edges = map_arrow(spots.join(table, equal).select(*whole, edge.alias("edge")), lambda batches: grouped(batches, costs, merges), f"{types}, edges array<bigint>, cuts array<int>")
    short = F.length("unit").between(1, MASK)
    if merges:
        return edges.select(*names, F.when(short, _merge_cuts()).alias("mask"), "cuts")
    return edges.select(*names, F.lit(None).cast("bigint").alias("mask"), F.when(short, _viterbi_cuts(costs)).otherwise(F.col("cuts")).alias("cuts"))


def _start(edge: Column) -> Column:
    return F.shiftright(edge, 20).bitwiseAND(F.lit(_PLACE)).cast("int")


def _end(edge: Column) -> Column:
    return edge.bitwiseAND(F.lit(_PLACE)).cast("int")


def _merge_cuts() -> Column:
    """Fold: of the edges (best first, as masks of their ends), the first whose ends are cuts with one cut between
    takes that cut away, until none does.

    One walk over the edges does it, unless it passes an edge with more than one cut between
    its ends: later merges may leave one. Then the first that fits is looked for anew, as
    often as there are characters."""
    size = F.length("unit")
    steps = F.sequence(F.lit(1), size)
    one = F.lit(1).cast("bigint")
    bit = lambda p: F.call_function("shiftleft", one, p)
    inside = lambda x: x - x.bitwiseAND(-x) * 3  # the bits between the two of x
    every = bit(size + 1) - one

    def walk(m: Column, x: Column) -> Column:
        between = m.bitwiseAND(inside(x))
        return F.when(m.bitwiseAND(x) != x, m).when(F.bit_count(between) <= 1, m.bitwiseXOR(between)).otherwise(m.bitwiseOR(F.lit(AGAIN)))

    def step(m: Column, _: Column) -> Column:
        fits = F.filter("edges", lambda x: (m.bitwiseAND(x) == x) & (F.bit_count(m.bitwiseAND(inside(x))) == 1))
        return F.coalesce(F.get(F.transform(F.slice(fits, 1, 1), lambda x: m.bitwiseAND(F.bitwise_not(inside(x)))), 0), m)

    # one-element arrays bind a value to a name, so that it is worked out once
    walked = F.transform(F.array(F.aggregate("edges", every, walk)), lambda m: F.when(m.bitwiseAND(F.lit(AGAIN)) == 0, m).otherwise(F.aggregate(steps, every, step)))

    return F.get(walked, 0)


def _viterbi_cuts(costs: list[float]) -> Column:
    """Fold over the positions: the least cost to reach each and the cut before it. A
    character without an edge costs more than any path of pieces."""
    size = F.length("unit")
    table = F.from_json(F.lit(json.dumps(costs)), "array<double>")
    worst = _worst(costs)
    state = F.array(F.struct(F.lit(0.0).alias("cost"), F.lit(-1).alias("back")))

    def step(acc: Column, e: Column) -> Column:
        own = F.struct((F.get(acc, e - 1)["cost"] + worst).alias("cost"), (e - 1).alias("back"))
        others = F.transform(F.filter("edges", lambda x: _end(x) == e), lambda x: F.struct((F.get(acc, _start(x))["cost"] + F.get(table, F.shiftright(x, 40).cast("int"))).alias("cost"), _start(x).alias("back")))
        return F.concat(acc, F.array(F.array_min(F.concat(F.array(own), others))))

    reached = F.aggregate(F.sequence(F.lit(1), size), state, step)
    back = lambda r: F.aggregate(F.sequence(F.lit(1), size), F.array(size), lambda cuts, _: F.when(F.get(cuts, F.lit(0)) > 0, F.concat(F.array(F.get(r, F.get(cuts, F.lit(0)))["back"]), cuts)).otherwise(cuts))
    return F.flatten(F.transform(F.array(reached), back))


class Joiner:
    """Puts texts' ids together from those of their units, which come first. The ids of all
    units lie end to end."""

    def __init__(self, model: Model):
        self.model = model
        self.parts, self.part_ids = pa.array([p for p, _, _ in model.pieces], pa.string()), np.array([i for _, _, i in model.pieces] + [-1], np.int32)
        self.ids, self.sizes = [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]

    def other(self, p: str) -> list[int]:
        """A character outside the vocabulary: its bytes' pieces."""
        return [self.model.first_byte + b for b in p.encode()] if self.model.first_byte >= 0 else [self.model.unknown]

    def learn(self, units: pa.Array, masks: pa.Array, cuts: pa.Array) -> None:
        n = len(units)
        bits = np.unpackbits(masks.fill_null(0).to_numpy().astype("<i8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row, at = np.nonzero(bits)
        if cuts.null_count < n:
            row = np.concatenate([row, np.repeat(np.arange(n), pc.list_value_length(cuts).fill_null(0).to_numpy())])
            at = np.concatenate([at, cuts.flatten().to_numpy()])
            order = np.argsort(row, kind="stable")
            row, at = row[order], at[order]
        same = np.flatnonzero(row[1:] == row[:-1])
        row, at = row[same], at[same]
        # pieces lie end to end in the units' bytes
        _, ends, data = units.cast(pa.string()).buffers()
        ends = np.frombuffer(ends, np.int32)[units.offset : units.offset + n + 1]
        data = memoryview(data or b"")[ends[0] : ends[-1]]
        lengths = pc.utf8_length(units).to_numpy()
        of_char = np.append(np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80), len(data))
        offsets = np.append(of_char[(np.cumsum(lengths) - lengths)[row] + at], len(data))
        parts = pa.StringArray.from_buffers(len(row), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data))
        ids = self.part_ids[pc.index_in(parts, value_set=self.parts).fill_null(-1).to_numpy()]
        counts = np.ones(len(ids), np.int64)
        others = {i: self.other(parts[i].as_py()) for i in np.flatnonzero(ids < 0).tolist()}
        if others:
            counts[list(others)] = [len(x) for x in others.values()]
            first = np.cumsum(counts) - counts
            ids = np.repeat(ids, counts)
            for i, own in others.items():
                ids[first[i] : first[i] + len(own)] = own
        sizes = np.bincount(row, counts, n).astype(np.int64)
        empty = np.flatnonzero(lengths == 0)
        if len(empty):
            forgotten = empty[-1] + 1
            self.ids, self.sizes = [ids[sizes[:forgotten].sum() :]], [sizes[forgotten:]]
        else:
            self.ids.append(ids)
            self.sizes.append(sizes)

    def texts(self, numbers: list[bytes]) -> pa.ListArray:
        """Ids of texts, each from the count of units before it and the numbers of its own."""
        self.ids, self.sizes = [np.concatenate(self.ids)], [np.concatenate(self.sizes)]
        (ids,), (sizes,) = self.ids, self.sizes
        own = np.frombuffer(b"".join(numbers), "<i4")
        lengths = np.fromiter(map(len, numbers), np.int64, len(numbers)) // 4
        first = np.cumsum(lengths) - lengths
        if (own[first] != len(sizes)).any():
            raise ValueError(f"{len(sizes)} units came before texts that follow {own[first].tolist()}")
        own = np.delete(own, first)
        counts = sizes[own]
        ends = np.concatenate([[0], np.cumsum(counts)])
        places = np.repeat((np.cumsum(sizes) - sizes)[own] - ends[:-1], counts) + np.arange(ends[-1])
        offsets = ends[np.concatenate([[0], np.cumsum(lengths - 1)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids[places], pa.int32()))

    def run(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of the lattice, units and texts, to (doc_id, text, ids)."""
        for batch in batches:
            is_text = batch.column("unit").is_null().to_numpy(zero_copy_only=False)
            turns = np.flatnonzero(np.diff(is_text)) + 1
            for first, last in zip([0, *turns], [*turns, batch.num_rows], strict=True):
                some = batch.slice(first, last - first)
                if last > first and not is_text[first]:
                    self.learn(some.column("unit"), some.column("mask"), some.column("cuts"))
                elif last > first:
                    for few in slices(iter([some]), "place", 4 << 20):
                        ids, texts, numbers = zip(*map(_unpacked, few.column("place").to_pylist()), strict=True)
                        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), self.texts(list(numbers))], names=["doc_id", "text", "ids"])


def _rows(docs: DataFrame, model: Model, id_col: str, text_col: str, remembered: int = REMEMBERED) -> DataFrame:
    longest, pieces = model.longest(), model.joined()
    units = map_arrow(ids_and_texts(docs, id_col, text_col), lambda batches: numbered(batches, pieces, longest, remembered), _UNITS)
    return folded(docs.sparkSession, units, model)


def encode(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """Per row of ``docs``: doc_id, text, ids (what the library gives for the whole text).

    Null and empty texts have no ids. Repeated rows are encoded each, a null doc_id stays
    null; an empty table gives no rows; further columns are ignored. Long runs of letters or
    signs take n log n of their length.
    """
    return map_arrow(_rows(docs, model, id_col, text_col, remembered), lambda batches: Joiner(model).run(batches), "doc_id bigint, text string, ids array<int>")


class Decoder:
    """Pieces end to end, byte pieces as bytes, blanks back, and the blank before the text
    away. Other ids stand for nothing."""

    def __init__(self, model: Model):
        table = {i: p.replace(BLANK, " ").encode() for p, _, i in model.pieces}
        if model.first_byte >= 0:
            table |= {model.first_byte + b: bytes([b]) for b in range(256)}
        self.bytes_of = pa.array([table.get(i, b"") for i in range(max(table, default=-1) + 1)] + [b""], pa.binary())

    def texts(self, ids: np.ndarray, ends: np.ndarray) -> Iterator[str]:
        """The texts of ids that lie end to end, each to its end."""
        n = len(self.bytes_of) - 1
        if len(ids) and not (0 <= ids.min() and ids.max() < n):
            ids = np.where((ids >= 0) & (ids < n), ids, n)
        found = self.bytes_of.take(pa.array(ids))
        _, offsets, data = found.buffers()
        offsets = np.frombuffer(offsets, np.int32)[ends].tolist()
        data = memoryview(data) if data is not None else memoryview(b"")
        for first, last in zip([0, *offsets], offsets, strict=False):
            # bytes may spell a blank, too
            yield str(data[first:last], "utf-8", "replace").replace(BLANK, " ").removeprefix(" ")


def decode_texts(ids: list[list[int]], model: Model) -> list[str]:
    """The texts that ids stand for."""
    ends = np.cumsum([len(x) for x in ids], dtype=np.int64)
    return list(Decoder(model).texts(np.array([i for x in ids for i in x], np.int64), ends))


def decode(rows: DataFrame, model: Model, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) of rows with ids; null ids give a null text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(1).to_pylist()
            texts = iter(decode_texts([x for x in ids if x is not None], model))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array([None if x is None else next(texts) for x in ids], pa.string())], names=["doc_id", "text"])

    return map_arrow(rows.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{ids_col}`").alias("ids")), run, "doc_id bigint, text string")


def _digests(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(model)
    for batch in slices(batches, "text"):
        ids, texts = batch.column("ids"), batch.column("text").to_pylist()
        ends = ids.offsets.to_numpy()
        values, ends = ids.values.to_numpy()[ends[0] : ends[-1]], ends - ends[0]
        raw = memoryview(values.astype("<u4").tobytes())
        n = np.diff(ends)
        crcs = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)]
        same = [own == (text or "") for own, text in zip(decoder.texts(values, ends[1:]), texts, strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(crcs, pa.int64()), pa.array(same, pa.bool_())], names=["doc_id", "n_pieces", "ids_crc32", "round_trip"])


_DIGEST = "doc_id bigint, n_pieces bigint, ids_crc32 bigint, round_trip boolean"


def digest(encoded: DataFrame, model: Model) -> DataFrame:
    """Per row of encode(): doc_id, n_pieces, ids_crc32 (little-endian unsigned 32-bit ids),
    round_trip (decoding gives the text; a null text counts as empty)."""
    return map_arrow(encoded, lambda batches: _digests(model, batches), _DIGEST)


def digests(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """digest(encode(docs)) with both in one Python worker."""
    return map_arrow(_rows(docs, model, id_col, text_col), lambda batches: _digests(model, Joiner(model).run(batches)), _DIGEST)
