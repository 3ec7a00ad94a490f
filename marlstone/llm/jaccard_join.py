"""N-gram Jaccard join of whole documents: a count-vector R-tree, and what leads up to it.

1. Texts become sets of 64-bit shingle hashes, array-wise over the bytes of many texts.
   Equal sets are one class from here on, under its smallest id.
2. Two sets of similarity 0.8 share a hash among the first n - ceil(0.8 n) + 1 of any common
   order. That order puts hashes that stand in a known share of all documents last, so
   passages that many documents share don't bring those documents together. Classes that
   share a hash are a cell; equal cells are one.
3. Links are found in two rounds, so that no cell writes out its pairs. First every class
   is held against one class of its cell of about its size. Verified links give components.
   Then each cell with more than one component is indexed: hashes fall into groups, the
   group counts of a set are a point, and an R-tree over the points is searched with the sum
   of coordinate minima, which no overlap exceeds. Only pairs of different components come
   out. Both rounds verify pairs on the texts themselves.

Nothing is capped or sampled: every pair that can be a link is verified, unless its two
ends are already connected. A hash of very many documents is one key nowhere: its cell's
smallest members are found by pre-aggregation and broadcast, and the tree search deals the
cell to tasks in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import ids_and_texts, join_heavy, map_arrow, remove, slices, stored
from marlstone.llm.components import components

WORDS = 5
#: Hashes per group, about, and the fewest groups. The groups of a set are a power of two, so
#: the finer of two vectors folds onto the other.
LOAD, GROUPS = 4, 128
BAND = np.log(1.25)
_R = np.random.default_rng(20240229)
_BYTE = _R.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _R.integers(0, 1 << 63, WORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (wrapping arithmetic)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(base: np.uint64, n: int) -> np.ndarray:
    held = _powers.get(str(base))
    if held is None or len(held) < n:
        held = np.full(max(n, 1 << 16), base, np.uint64)
        held[0] = 1
        np.cumprod(held, out=held)
        if n <= 1 << 23:
            _powers[str(base)] = held
    return held[:n]


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, end to end, and where each text's begin
    (one more entry than texts)."""
    data = np.frombuffer(b" " + b" ".join(t.encode() for t in texts) + b" ", np.uint8)
    lengths = np.array([len(t.encode()) for t in texts], np.int64)
    data = data + np.where((data >= 65) & (data <= 90), np.uint8(32), np.uint8(0))
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1
    ends = np.flatnonzero(blank[1:] & ~blank[:-1]) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power(_BASE, len(data)), out=sums[1:])
    words = mix((sums[ends] - sums[starts]) * _power(_INVERSE, len(data))[starts])
    text_starts = np.concatenate([[1], 1 + np.cumsum(lengths + 1)])
    owner = np.searchsorted(text_starts, starts, "right") - 1
    count = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(count)])
    full = words[: max(len(words) - WORDS + 1, 0)] * _PLACE[0]
    for k in range(1, WORDS):
        full = full + words[k : k + len(full)] * _PLACE[k]
    at = np.flatnonzero(owner[: len(full)] == owner[WORDS - 1 : WORDS - 1 + len(full)])
    hashes, whose = mix(full[at]), owner[at]
    short = np.flatnonzero((count > 0) & (count < WORDS))
    if len(short):
        made = [mix(np.array([(words[first[d] : first[d + 1]] * _PLACE[: count[d]]).sum(dtype=np.uint64) + np.uint64(count[d])], np.uint64))[0] for d in short]
        hashes, whose = np.concatenate([hashes, np.array(made, np.uint64)]), np.concatenate([whose, short])
    order = np.lexsort((hashes, whose))
    hashes, whose = hashes[order], whose[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (whose[1:] != whose[:-1])
    hashes, whose = hashes[new], whose[new]
    return hashes, np.searchsorted(whose, np.arange(len(texts) + 1))


def groups_of(n: np.ndarray) -> np.ndarray:
    """Groups for sets of these sizes."""
    return np.maximum(GROUPS, 1 << np.ceil(np.log2(np.maximum(n, 1) / LOAD)).clip(min=0).astype(np.int64))


def folded(counts: np.ndarray, groups: int) -> np.ndarray:
    """Count vectors over fewer groups; 255 stands for 255 or more."""
    if counts.shape[-1] == groups:
        return counts
    return counts.reshape(*counts.shape[:-1], counts.shape[-1] // groups, groups).sum(-2, dtype=np.int64).clip(max=255).astype(np.uint8)


def needed_overlap(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Smallest intersection of linked sets of sizes a and b: 100 i >= percent (a + b - i)."""
    return -(-percent * (a + b) // (100 + percent))


class Frequent:
    """Hashes in a given share of a task's documents, in bounded memory: distinct hashes and
    their counts, of which the rarest go when they are more than ``most``. A count may then
    be too low, which changes the order that hashes are put in and no result."""

    def __init__(self, share: float, most: int = 2_000_000):
        self.share, self.most, self.rows = share, most, 0
        self.hashes, self.counts = np.array([], np.uint64), np.array([], np.int64)
        self.new: list[np.ndarray] = []

    def add(self, hashes: np.ndarray, rows: int) -> None:
        self.rows += rows
        self.new.append(hashes)
        if sum(map(len, self.new)) > self.most:
            self.settle()

    def settle(self) -> None:
        every = np.concatenate([self.hashes, *self.new])
        weight = np.concatenate([self.counts, np.ones(len(every) - len(self.hashes), np.int64)])
        order = np.argsort(every)
        every, weight = every[order], weight[order]
        starts = _starts(every) if len(every) else np.array([], np.int64)
        self.hashes, self.counts, self.new = every[starts], np.add.reduceat(weight, starts) if len(starts) else weight, []
        least = 1
        while len(self.hashes) > self.most:
            least += 1
            self.hashes, self.counts = self.hashes[self.counts >= least], self.counts[self.counts >= least]

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        self.settle()
        often = self.counts >= max(2.0, self.share * self.rows)
        return self.hashes[often], self.counts[often]


def _frequent(spark: SparkSession, docs: DataFrame, share: float, least: int, most: int = 1_000_000) -> np.ndarray:
    """Hashes in at least that share of the documents, sorted. Such a hash has that share in
    some task, so tasks name only hashes which have it there; documents of mean size n have
    at most n / share of them. Any set would do, as it only orders the hashes, so the
    ``most`` most frequent bound what is sent to the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Frequent(share)
        for batch in slices(batches, "text", 4 << 20):
            held.add(shingle_sets([t or "" for t in batch.column(1).to_pylist()])[0], batch.num_rows)
        hashes, counts = held.found()
        yield pa.RecordBatch.from_arrays([pa.array(np.append(hashes.view(np.int64), 0)), pa.array(np.append(counts, 0).astype(np.int64)), pa.array([0] * len(hashes) + [held.rows], pa.int64())], names=["hash", "n", "rows"])

    counted, path = stored(spark, map_arrow(docs, run, "hash bigint, n bigint, rows bigint"), "counts")
    rows = counted.agg(F.sum("rows")).first()[0] or 0
    often = counted.groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") >= max(least, share * rows))
    got = often.orderBy(F.desc("n"), "hash").limit(most).select("hash").toArrow().column(0)
    remove(spark, path)
    return np.sort(np.asarray(got.to_numpy(), np.int64).view(np.uint64))


def _profiles(docs: DataFrame, sent: Broadcast, percent: int) -> DataFrame:
    """Per document: n, the set's 128-bit identity, its group counts and its prefix, the
    frequent hashes of that apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = sent.value
        for batch in slices(batches, "text", 4 << 20):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            hashes, at = shingle_sets(texts)
            n = np.diff(at)
            whose = np.repeat(np.arange(len(texts)), n)
            sums = [np.zeros(len(hashes) + 1, np.uint64) for _ in range(2)]
            np.cumsum(mix(hashes ^ _PLACE[0]), out=sums[0][1:])
            np.cumsum(mix(hashes + _PLACE[1]), out=sums[1][1:])
            identity = [(s[at[1:]] - s[at[:-1]]).view(np.int64) for s in sums]
            groups = groups_of(n)
            first = np.concatenate([[0], np.cumsum(groups)])
            counts = np.bincount(np.repeat(first[:-1], n) + (hashes & (np.repeat(groups, n) - 1).astype(np.uint64)).astype(np.int64), minlength=int(first[-1])).clip(max=255).astype(np.uint8)
            often = np.isin(hashes, frequent) if len(frequent) else np.zeros(len(hashes), bool)
            order = np.lexsort((hashes, often, whose))
            rank = np.arange(len(hashes)) - np.repeat(at[:-1], n)
            size = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
            inside = rank < np.repeat(size, n)
            lists = []
            for kind in (False, True):
                own = inside & (often[order] == kind)
                lists.append(pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(own)])[at], pa.int32()), pa.array(hashes[order][own].view(np.int64))))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(identity[0]), pa.array(identity[1]), pa.array([counts[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)], pa.binary()), *lists],
                names=["doc_id", "n", "s1", "s2", "counts", "prefix", "often"],
            )

    return map_arrow(docs, run, "doc_id bigint, n bigint, s1 bigint, s2 bigint, counts binary, prefix array<bigint>, often array<bigint>")


def _runs(batches: Iterator[pa.RecordBatch], keys: int, most: int = 1 << 62) -> Iterator[list[np.ndarray]]:
    """Columns of sorted batches, cut so that no run of equal first ``keys`` columns is split
    unless it has more than ``most`` rows."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(new[0]):
            continue
        other = np.zeros(len(new[0]), bool)
        for k in range(keys):
            other |= new[k] != new[k][-1]
        cut = int(np.flatnonzero(other)[-1]) + 1 if other.any() else 0
        if held and not cut and any(held[-1][k][-1] != new[k][-1] for k in range(keys)):
            yield [np.concatenate(p) for p in zip(*held, strict=True)]
            held = []
        if cut:
            yield [np.concatenate(p) for p in zip(*held, [c[:cut] for c in new], strict=True)]
            held, new = [], [c[cut:] for c in new]
        held.append(new)
        if sum(len(h[0]) for h in held) > most:
            yield [np.concatenate(p) for p in zip(*held, strict=True)]
            held = []
    if held:
        yield [np.concatenate(p) for p in zip(*held, strict=True)]


def _starts(*keys: np.ndarray) -> np.ndarray:
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _bands(n: np.ndarray) -> np.ndarray:
    return np.floor(np.log(n) / BAND).astype(np.int64)


_CELLS = "cell bigint, id bigint, n bigint, hub bigint"


def _cells(batches: Iterator[pa.RecordBatch], most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Of rows (hash, id, n) sorted by hash and id: the distinct cells of two or more ids. A
    cell's name is a hash of its members; hub is the smallest member of about the row's size.
    A run of more than ``most`` rows passes in parts under a name of its hash."""
    seen: set[int] = set()
    long: tuple[int, dict[int, int]] | None = None
    for token, id_, n in _runs(batches, 1, most):
        if long is not None and token[0] != long[0]:
            long = None
        if long is None and len(token) > most and token[0] == token[-1]:
            long = int(token[0]), {}
        if long is not None:
            lead = int(np.searchsorted(token != long[0], True))
            if lead:
                band = _bands(n[:lead])
                kinds, first = np.unique(band, return_index=True)
                for b, i in zip(kinds.tolist(), id_[first].tolist(), strict=True):
                    long[1].setdefault(b, i)
                hubs = np.array([long[1][b] for b in kinds.tolist()], np.int64)[np.searchsorted(kinds, band)]
                yield pa.RecordBatch.from_arrays([pa.array(mix(token[:lead].view(np.uint64)).view(np.int64)), pa.array(id_[:lead]), pa.array(n[:lead]), pa.array(hubs)], names=["cell", "id", "n", "hub"])
            if lead < len(token):
                long = None
            token, id_, n = token[lead:], id_[lead:], n[lead:]
        starts = _starts(token) if len(token) else np.array([], np.int64)
        sizes = np.diff(np.r_[starts, len(token)])
        many = np.repeat(sizes > 1, sizes)
        token, id_, n, sizes = token[many], id_[many], n[many], sizes[sizes > 1]
        if not len(token):
            continue
        starts = np.r_[0, np.cumsum(sizes)[:-1]]
        names = mix(np.add.reduceat(mix(id_.astype(np.int64).view(np.uint64) + _BASE), starts) + sizes.astype(np.uint64)).view(np.int64)
        first = np.zeros(len(names), bool)
        first[np.unique(names, return_index=True)[1]] = True
        first &= np.array([x not in seen for x in names.tolist()], bool)
        seen.update(names[first].tolist())
        if len(seen) > 500_000:
            seen.clear()
        keep = np.repeat(first, sizes)
        cell, id_, n = np.repeat(names, sizes)[keep], id_[keep], n[keep]
        if not len(cell):
            continue
        band = _bands(n)
        order = np.lexsort((id_, band, cell))
        cell, id_, n, band = cell[order], id_[order], n[order], band[order]
        starts = _starts(cell, band)
        hub = np.repeat(id_[starts], np.diff(np.r_[starts, len(cell)]))
        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(id_), pa.array(n), pa.array(hub)], names=["cell", "id", "n", "hub"])


def _frequent_cells(heads: DataFrame) -> DataFrame:
    """The same of frequent hashes, without a shuffle of their rows: a hash is a cell, its
    hubs are pre-aggregated and sent to the rows. A band spans a quarter in size, so there
    are at most some hundred hubs for each of the hashes."""
    band = F.floor(F.log(F.col("n").cast("double")) / float(BAND)).cast("int")
    rows = heads.where(F.size("often") > 0).select(F.explode("often").alias("cell"), "id", "n", band.alias("band"))
    hubs = rows.groupBy("cell", "band").agg(F.min("id").alias("hub"), F.count("*").alias("rows"))
    return join_heavy(rows, hubs, ["cell", "band"], "rows").select("cell", "id", "n", "hub")


def _bound(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Upper bound of the overlap: summed minima of the counts (255 stands for 255 or more)."""
    low = np.minimum(a, b)
    return low.sum(-1, dtype=np.int64) + np.where((low == 255).any(-1), np.minimum(na, nb), 0)


class CountTree:
    """An R-tree over count vectors, bulk-loaded: points in order of size and then of their
    counts, ``fan`` to a node; a node has its least and greatest size and count maxima."""

    def __init__(self, n: np.ndarray, counts: np.ndarray, fan: int = 16):
        spread = np.argsort(-counts.astype(np.float32).var(0))[:2]
        self.order = np.lexsort((counts[:, spread[1]], counts[:, spread[0]], n))
        self.n, self.counts, self.fan = n[self.order], counts[self.order], fan
        self.levels = [(self.n, self.n, self.counts)]
        while len(self.levels[-1][0]) > fan:
            low, high, top = self.levels[-1]
            at = np.arange(0, len(low), fan)
            self.levels.append((np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(top, at, axis=0)))

    def search(self, n: int, counts: np.ndarray, percent: int) -> np.ndarray:
        """Points that may be linked with a point, by their places in the input."""
        at = np.arange(len(self.levels[-1][0]))
        for level in range(len(self.levels) - 1, -1, -1):
            low, high, top = (x[at] for x in self.levels[level])
            at = at[(100 * n >= percent * low) & (100 * high >= percent * n) & (_bound(top, counts, high, np.int64(n)) >= needed_overlap(low, np.int64(n), percent))]
            if level:
                at = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
                at = at[at < len(self.levels[level - 1][0])]
        return self.order[at]


def _near(cells: dict[int, np.ndarray], n: np.ndarray, counts: np.ndarray, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row its near rows, each pair of rows at least once. ``cells`` has the rows by
    their number of groups. Linked sets differ by a quarter in size, so their groups are the
    same or differ by a factor of two: a tree holds the rows of one number of groups and,
    folded, those of twice as many."""
    for groups, own in cells.items():
        finer = cells.get(2 * groups, np.array([], np.int64))
        points = np.frombuffer(b"".join(counts[own]), np.uint8).reshape(-1, groups)
        others = folded(np.frombuffer(b"".join(counts[finer]), np.uint8).reshape(-1, 2 * groups), groups)
        held, both = np.concatenate([own, finer]), np.concatenate([points, others])
        if len(held) > 1:
            tree = CountTree(n[held], both)
            for at, point in zip(own, points, strict=True):
                yield at, held[tree.search(int(n[at]), point, percent)]


def _tree_pairs(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of rows (cell, i, j, id, n, component, side, counts) sorted by cell, i, j."""

        def pairs(out_a: list[np.ndarray], out_b: list[np.ndarray]) -> pa.RecordBatch:
            found = np.unique(np.c_[np.concatenate(out_a), np.concatenate(out_b)], axis=0)
            out_a.clear(), out_b.clear()
            return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], names=["a", "b"])

        out_a, out_b, held = [], [], 0
        for cell, i, j, id_, n, comp, side, counts in _runs(batches, 3):
            groups = groups_of(n)
            starts = _starts(cell, i, j)
            for s, e in zip(starts, np.r_[starts[1:], len(cell)], strict=True):
                kinds = {int(g): s + np.flatnonzero(groups[s:e] == g) for g in np.unique(groups[s:e])}
                for at, near in _near(kinds, n, counts, percent):
                    near = near[(comp[near] != comp[at]) & ((i[s] == j[s]) | (side[near] != side[at]))]
                    if len(near):
                        out_a.append(np.minimum(id_[near], id_[at]))
                        out_b.append(np.maximum(id_[near], id_[at]))
                        held += len(near)
                    if held > 200_000:
                        yield pairs(out_a, out_b)
                        held = 0
        if out_a:
            yield pairs(out_a, out_b)

    return run


def _bound_filter(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            va, vb = ([np.frombuffer(v, np.uint8) for v in batch.column(c).to_pylist()] for c in ("va", "vb"))
            groups = np.array([min(len(a), len(b)) for a, b in zip(va, vb, strict=True)])
            good = np.zeros(batch.num_rows, bool)
            for g in np.unique(groups):
                at = np.flatnonzero(groups == g)
                left, right = (np.stack([folded(v[k], int(g)) for k in at]) for v in (va, vb))
                good[at] = _bound(left, right, na[at], nb[at]) >= needed_overlap(na[at], nb[at], percent)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good)) for c in ("a", "b")], names=["a", "b"])

    return run


def _verify(spark: SparkSession, docs: DataFrame, pairs: DataFrame, percent: int, most_bits: int = 1 << 28, group: int = 256) -> DataFrame:
    """Those of ``pairs`` (a, b) whose texts are linked. Texts travel only if a bit table has
    their id, of 32 bits for each pair up to ``most_bits`` (32 MB); beyond some 10^8 ids it
    lets ever more others through, which are shuffled in vain. The partners of one text come
    in groups of about ``group``."""
    bits = min(most_bits, 1 << max(16, (32 * pairs.count()).bit_length()))
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    place = F.pmod(F.xxhash64("id"), F.lit(bits))
    words = ids.select((place / 64).cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(pmod(pmod(xxhash64(id), {bits}), 64) as int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    got = words.toArrow()  # at most bits / 64 rows
    table = np.zeros(bits // 64, np.uint64)
    table[got.column(0).to_numpy()] = got.column(1).to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(table)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy()
            keep = (sent.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)
            yield batch.filter(pa.array(keep == 1)).select(["id", "text"])

    rows = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").alias("id"), "text").select(place.alias("place"), "id", "text")
    texts = map_arrow(rows, wanted, "id bigint, text string")
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / group).alias("parts"))
    dealt = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), "b")
    asked = dealt.select("a", "part", F.col("b").alias("id"), F.lit(1).alias("role")).union(dealt.select("a", "part", F.col("a").alias("id"), F.lit(0).alias("role")).distinct())
    given = asked.join(texts, "id").repartition("a", "part").sortWithinPartitions("a", "part", "role")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_sets = None, []
        for batch in slices(batches, "text", 4 << 20):
            a, part, id_, role = (batch.column(c).to_pylist() for c in ("a", "part", "id", "role"))
            hashes, at = shingle_sets(batch.column("text").to_pylist())
            linked = []
            for k in range(len(a)):
                own = hashes[at[k] : at[k + 1]]
                if (a[k], part[k]) != hub:
                    hub, hub_sets = (a[k], part[k]), []
                if not role[k]:
                    hub_sets.append(own.copy())
                    continue
                for other in hub_sets:
                    place = np.searchsorted(other, own)
                    both = int((other[np.minimum(place, len(other) - 1)] == own).sum()) if len(other) else 0
                    if both and 100 * both >= percent * (len(own) + len(other) - both):
                        linked.append((a[k], id_[k]))
                        break
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in linked], pa.int64()) for i in range(2)], names=["a", "b"])

    return map_arrow(given, run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80, share: float = 0.002, least: int = 16, block: int = 8_192) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id.

    Words are runs of bytes other than ASCII white space, with A-Z lowered; a set holds the
    distinct 5-word shingles, of fewer words the whole sequence. Sets are linked when
    100 * intersection >= percent * union; component_id is the smallest id that links reach.
    Null and empty texts have 0 shingles and are their own component, as is a null id's row
    (component null unless a copy has an id). A repeated row shares its copy's component; an
    empty table gives no rows; further columns are ignored. Hashes of 64 bits stand for
    shingles, sums of 128 bits for sets. Cells of over ``block`` members are searched block
    against block, each pair of blocks a task of its own.
    """
    spark = docs.sparkSession
    docs = ids_and_texts(docs, id_col, text_col)
    sent = spark.sparkContext.broadcast(_frequent(spark, docs, share, least))
    profiles, _ = stored(spark, _profiles(docs, sent, percent), "profiles")
    filled = profiles.where("n > 0")
    classes, _ = stored(spark, filled.groupBy("s1", "s2").agg(F.min("doc_id").alias("id"), F.count("*").alias("rows")), "classes")
    firsts = classes.where("id IS NOT NULL").hint("shuffle_hash")
    heads = filled.withColumnRenamed("doc_id", "id").join(firsts, ["id", "s1", "s2"], "left_semi")
    tokens = heads.select(F.explode("prefix").alias("hash"), "id", "n").repartition("hash").sortWithinPartitions("hash", "id")
    found = map_arrow(tokens, _cells, _CELLS)
    if len(sent.value):
        found = found.union(_frequent_cells(heads))
    cells, cells_path = stored(spark, found.dropDuplicates(["cell", "id"]), "cells")

    points = heads.select("id", "n", "counts")
    pairs = cells.where("hub <> id").select(F.col("hub").alias("a"), F.col("id").alias("b")).distinct()
    sized = pairs.join(points.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("vb")), "b").join(points.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("counts").alias("va")), "a")
    first, first_path = stored(spark, map_arrow(sized, _bound_filter(percent), "a bigint, b bigint"), "pairs")
    links, links_path = stored(spark, _verify(spark, docs, first, percent), "links")
    labels, labels_path = components(spark, links)

    known = cells.select("cell", "id", "n").join(labels.select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    known, known_path = stored(spark, known, "known")
    open_cells = known.groupBy("cell").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("rows")).where("x <> y").select("cell", "rows", F.col("rows").alias("size"))
    parts = F.ceil(F.col("size") / block).cast("int")
    spread = join_heavy(known, open_cells, ["cell"], "rows").withColumn("side", F.pmod(F.xxhash64("id"), parts).cast("int"))
    # a member meets every block of its cell, its own included, in the task of the two blocks
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    spread = spread.select("cell", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"), "id", "n", "component", "side")
    grid = spread.join(points.select("id", "counts"), "id").select("cell", "i", "j", "id", "n", "component", "side", "counts").repartition("cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    more = map_arrow(grid, _tree_pairs(percent), "a bigint, b bigint").distinct().join(first, ["a", "b"], "left_anti")
    second, second_path = stored(spark, more, "pairs")
    both, both_path = stored(spark, links.union(_verify(spark, docs, second, percent)), "links")
    remove(spark, labels_path)
    final, _ = components(spark, both)
    for path in (cells_path, known_path, first_path, second_path, links_path, both_path):
        remove(spark, path)

    of_class = classes.join(final.select(F.col("node").alias("id"), "component"), "id", "left").select("s1", "s2", F.coalesce("component", "id").alias("component"), "rows")
    rows = profiles.select("doc_id", F.col("n").alias("n_shingles"), "s1", "s2")
    copies = join_heavy(rows.where("n_shingles > 0"), of_class, ["s1", "s2"], "rows").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return copies.union(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """One row of each group of near copies, with all its columns: of the smallest id, and
    of rows that repeat an id and its text the first. Rows that share an id but not a text
    are told apart by a hash of both, which takes the id's place in the search if there are
    such rows: each goes only if its own text or a linked one stays. Rows without an id stay."""
    own = docs.where(F.col(f"`{id_col}`").isNotNull()).select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"))
    unique = own.groupBy("id").agg(F.min("h").alias("x"), F.max("h").alias("y")).where("x <> y").isEmpty()
    key = F.col(f"`{id_col}`").cast("bigint") if unique else F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))
    rows = docs.withColumn("__key", key)
    named = rows.where(F.col(f"`{id_col}`").isNotNull())
    texts = named.select("__key", F.col(f"`{text_col}`").alias("text"))
    found = near_duplicates(texts, "__key", "text", **params).select(F.col("doc_id").alias("__key"), "component_id")
    ids = named.select("__key", F.col(f"`{id_col}`").alias("id")).distinct()
    first = found.distinct().join(ids, "__key").groupBy("component_id").agg(F.min(F.struct("id", "__key"))["__key"].alias("__key"))
    kept = named.join(first.select("__key"), "__key", "left_semi").dropDuplicates(["__key"])
    unnamed = docs.where(F.col(f"`{id_col}`").isNull())
    return kept.select(*[f"`{c}`" for c in docs.columns]).unionByName(unnamed)
