"""Merges that depend on the order of records: each goes into the first kept one that fits.

A task reads the records of a group in order and decides by their keys alone where each goes;
values are put together afterwards by an aggregation. Which kept records may fit is looked up,
not searched: kept records are indexed by the keys that both they and the new record
state, so a group is merged in about the time its records take to be read. A task holds the
keys of one group's kept records at a time.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql.types import IntegerType, StructField, StructType


#: Of so many kept records each is looked at; an index of more is worth its making.
FEW = 16


class Kept:
    """Kept records by what they state. A record has ``parts``, which fit where either side has
    none (null) or both are equal, and ``bases``, of which one has to be the same. Of more than
    FEW, for each set of parts that kept records state, and each subset that a new one states
    too, a table from their values to the records is made when first asked for."""

    def __init__(self):
        self._state: list[tuple[int, tuple, tuple]] = []
        self._members: dict[int, list[int]] = {}
        self._tables: dict[int, dict[int, dict[tuple, list[int]]]] = {}

    @staticmethod
    def _stated(parts: tuple) -> int:
        return sum(1 << i for i, p in enumerate(parts) if p is not None)

    @staticmethod
    def _of(parts: tuple, both: int) -> tuple:
        return tuple(p for i, p in enumerate(parts) if both >> i & 1)

    def put(self, at: int, bases: tuple, parts: tuple) -> None:
        """A new record, or what a kept one has become."""
        if len(self._state) < FEW or (at < FEW and not self._members):
            self._state[at : at + 1] = [(None, bases, parts)]
            return
        if not self._members:  # one more than few: all are indexed from here on
            few, self._state = self._state, []
            for i, (_, *record) in enumerate(few):
                self._put(i, *record)
        self._put(at, bases, parts)

    def _put(self, at: int, bases: tuple, parts: tuple) -> None:
        stated = self._stated(parts)
        if at == len(self._state):
            self._state.append((stated, bases, parts))
        elif self._state[at] == (stated, bases, parts):
            return
        else:
            self._state[at] = (stated, bases, parts)
        self._members.setdefault(stated, []).append(at)
        for both, table in self._tables.setdefault(stated, {}).items():
            self._file(table, both, at)

    def _file(self, table: dict, both: int, at: int) -> None:
        _, bases, parts = self._state[at]
        for base in bases:
            places = table.setdefault((base, self._of(parts, both)), [])
            i = bisect_left(places, at)
            if i == len(places) or places[i] != at:
                places.insert(i, at)

    def first(self, bases: tuple, choices: tuple, fits: Callable[[int], bool] | None = None) -> int | None:
        """The first kept record that fits: ``choices`` are each part's values that do (None: not
        stated), ``fits`` what else has to hold."""
        if not self._members:
            return self._first_of_few(bases, choices, fits)
        asked, best = self._stated(choices), None
        for stated, tables in self._tables.items():
            both = stated & asked
            table = tables.get(both)
            if table is None:
                table = tables[both] = {}
                for at in self._members[stated]:
                    if self._state[at][0] == stated:
                        self._file(table, both, at)
            values = [c for i, c in enumerate(choices) if both >> i & 1]
            for base in bases:
                for chosen in product(*values):
                    places = table.get((base, chosen))
                    if places:
                        best = self._least(places, stated, both, base, chosen, best, fits)
        return best

    def _first_of_few(self, bases: tuple, choices: tuple, fits: Callable[[int], bool] | None) -> int | None:
        for at, (_, own, parts) in enumerate(self._state):
            for part, chosen in zip(parts, choices):  # noqa: B905
                if part is not None and chosen is not None and part not in chosen:
                    break
            else:
                if any(base in own for base in bases) and (fits is None or fits(at)):
                    return at
        return None

    def _least(self, places: list[int], stated: int, both: int, base, chosen: tuple, best: int | None, fits) -> int | None:
        gone = []
        for at in places:
            if best is not None and at >= best:
                break
            now, bases, parts = self._state[at]
            if now != stated or base not in bases or self._of(parts, both) != chosen:
                gone.append(at)  # has become another
            elif fits is None or fits(at):
                best = at
                break
        for at in gone:
            del places[bisect_left(places, at)]
        return best


class NullTolerant:
    """Fits where every key that both state is equal; takes the keys it lacks."""

    def __init__(self):
        self._kept, self._keys, self._seen = Kept(), [], 0

    def place(self, record: tuple) -> tuple[int, int]:
        """Of (keys,): where it goes, and the rank of its values."""
        (keys,) = record
        parts = tuple(k or None for k in keys)
        at = self._kept.first((None,), tuple(None if p is None else (p,) for p in parts))
        if at is None:
            at = len(self._keys)
            self._keys.append(parts)
        else:
            self._keys[at] = tuple(p if q is None else q for p, q in zip(parts, self._keys[at], strict=True))
        self._kept.put(at, (None,), self._keys[at])
        self._seen += 1
        return at, self._seen


class Fuzzy:
    """Fits where unit is equal, manufacturer and solvent don't conflict, upper ratios are within
    the tolerance, and phase, material or column is the same. Of two that become one that
    with more values wins: its values come first, those of the other behind all so far."""

    def __init__(self, tolerance: float):
        self._kept, self._tolerance = Kept(), tolerance
        self._state: list[tuple[tuple, float | None, int]] = []
        self._ranks: list[list[int]] = []

    def _filed(self, at: int) -> None:
        (unit, maker, solvent, *same), upper, _ = self._state[at]
        cell = None if upper is None else self._cell(upper)
        self._kept.put(at, tuple((i, unit, v) for i, v in enumerate(same) if v), (maker or None, solvent or None, cell))

    def _cell(self, upper: float) -> int:
        return int(upper // self._tolerance) if self._tolerance else hash(upper)

    def place(self, record: tuple) -> tuple[int, int]:
        """Of (keys, upper ratio, bits of the fields with a value)."""
        keys, upper, values = record
        unit, maker, solvent, *same = keys
        near = None
        if upper is not None:
            cell = self._cell(upper)
            near = (cell - 1, cell, cell + 1)

        def fits(i: int) -> bool:
            other = self._state[i][1]
            return upper is None or other is None or abs(other - upper) <= self._tolerance

        bases = tuple((i, unit, v) for i, v in enumerate(same) if v)
        at = self._kept.first(bases, ((maker,) if maker else None, (solvent,) if solvent else None, near), fits)
        if at is None:
            at = len(self._state)
            self._state.append((tuple(keys), upper, values))
            self._ranks.append([0, 0])
            self._filed(at)
            return at, 0
        kept, top, held = self._state[at]
        wins = values.bit_count() > held.bit_count()
        first, then = ((keys, upper), (kept, top)) if wins else ((kept, top), (keys, upper))
        self._state[at] = (tuple(a or b for a, b in zip(first[0], then[0], strict=True)), then[1] if first[1] is None else first[1], values | held)
        self._filed(at)
        ranks = self._ranks[at]
        ranks[wins] += -1 if wins else 1
        return at, ranks[wins]


def _values(column: pa.Array) -> list:
    """The column in Python; lists (of one length, none null) by way of all their elements."""
    if not pa.types.is_list(column.type) or not len(column):
        return column.to_pylist()
    flat = column.flatten().to_pylist()
    n = len(flat) // len(column)
    return [flat[i : i + n] for i in range(0, len(flat), n)]


def placed(rows: DataFrame, keys: dict[str, Column], fold: Callable[[], object], group: str, order: str) -> DataFrame:
    """Rows with kept_idx, the kept record each belongs to, and __rank, by which values of a
    record come before others in it. ``keys`` is what the fold's place()
    is given; arrays among them are of one length."""
    held = rows.withColumns(keys).repartition(group).sortWithinPartitions(group, order)
    names = list(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, None
        for batch in batches:
            at, ranks = [], []
            records = zip(*(_values(batch.column(n)) for n in names), strict=True)
            for own, record in zip(batch.column(group).to_pylist(), records, strict=True):
                if now is None or own != key:
                    key, now = own, fold()
                place, rank = now.place(record)
                at.append(place)
                ranks.append(rank)
            batch = batch.drop_columns(names)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at, pa.int32()), pa.array(ranks, pa.int32())], names=[*batch.schema.names, "kept_idx", "__rank"])

    return held.mapInArrow(run, StructType([*rows.schema.fields, StructField("kept_idx", IntegerType()), StructField("__rank", IntegerType())]))
