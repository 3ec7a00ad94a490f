"""Repair of conversation structure by a dynamic program shared over a trie.

A conversation is a signature of one letter per row: the initial of its role (o: any but s, u,
a), upper case if its text breaks off, or x if it has to go as blank or repeated.
What is left of a repair from row i on, given the role before, depends on the rest of the
signature alone. So signatures are read from the last row to the first and sorted; in sorted
order they are the walk of their prefix trie, and the walk holds one layer of the program for
each letter on the way from the root to where it stands. A signature goes back to the letter
where it parts from the one before, adds its own layers below and reads its answer off at
its end. Each shared prefix is worked out once; equal signatures share all of it.

A layer has, for each of four states (nothing yet, after a system row, after a user's, after an
assistant's), the cost of the cheapest rest and its first edit. From a state each kind of edit
leads to one next state only, so taking the least letter among the cheapest gives the least
word of edits. Texts take no part but for their hash and their faults.
"""

from __future__ import annotations

import functools
import hashlib
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from marlstone.llm.common import stored

SPACE = " \t\n\x0b\x0c\r"
NEVER = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: The state after a kept or new row, by the role that stands there.
NEXT = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: The turn that may follow a state.
FOLLOWS = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
DELETE, INSERT, REROLE, CUT_OFF = 4, 3, 3, 3
LAST = ((0, ""), (NEVER, ""), (NEVER, ""), (0, ""))


@functools.cache
def layer(letter: str, rest: tuple) -> tuple[int, tuple]:
    """The layer of a row and all behind it, from the layer of what is behind it: its least
    cost, and costs above it with first edits. Costs of states differ by a few edits, so there
    are few distinct layers, each kept once."""
    initial, more = letter.lower(), CUT_OFF if letter.isupper() else 0
    own = []
    for state in range(4):
        ways = [(DELETE + rest[state][0], "D")]
        if letter != "x":
            want = FOLLOWS[state]
            if initial == want or (initial == "s" and state == START):
                ways.append((more + rest[NEXT[initial]][0], "K"))
            if initial != want:
                ways.append((more + REROLE + rest[NEXT[want]][0], "R"))
        own.append(min(ways))
    return inserted(own)


def inserted(own: list | tuple) -> tuple[int, tuple]:
    """A layer in which a turn may be put in first: of equal costs the lesser letter."""
    user, assistant = (min(own[a], (INSERT + own[b][0], "I")) for a, b in ((USER, ASSISTANT), (ASSISTANT, USER)))
    start, system = (min(own[s], (INSERT + user[0], "I")) for s in (START, SYSTEM))
    least = min(start[0], system[0], user[0], assistant[0])
    return least, tuple((cost - least, edit) for cost, edit in (start, system, user, assistant))


class Walk:
    """Answers signatures that come in sorted order."""

    def __init__(self):
        least, last = inserted(LAST)
        self.word, self.layers, self.least = "", [last], [least]

    def answer(self, word: str) -> tuple[int, str]:
        """Cost and edits of the signature whose letters, last row first, are ``word``."""
        same = len(os.path.commonprefix((word, self.word)))
        del self.layers[same + 1 :], self.least[same + 1 :]
        for letter in word[same:]:
            more, new = layer(letter, self.layers[-1])
            self.layers.append(new)
            self.least.append(self.least[-1] + more)
        self.word = word
        edits, state, at = [], START, len(word)
        while True:
            edit = self.layers[at][state][1]
            if not edit:
                return self.least[-1] + self.layers[-1][START][0], "".join(edits)
            edits.append(edit)
            if edit == "K" and word[at - 1].lower() == "s":
                state = SYSTEM
            elif edit != "D":
                state = NEXT[FOLLOWS[state]]
            at -= edit != "I"


def damaged(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, damage: bool = True) -> DataFrame:
    """(conv_id, turn, role, text, sha, copy, gone): nulls of role and text as one space, and
    the damage that crc32 of ``conv_id:turn`` (a null: one space), modulo 20, picks: 0 drops
    the row, 1 empties its text, 2 takes its ends of sentences, 3 repeats it, 4 makes it the user's."""
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    conv, turn, role, text = (F.col(f"`{c}`") for c in (conv_col, turn_col, role_col, text_col))
    pick = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20 if damage else F.lit(19)
    rows = rows.select(conv.alias("conv_id"), turn.alias("turn"), blank(role).alias("role"), blank(text).alias("text"), pick.alias("pick"))
    rows = rows.withColumns({
        "text": F.when(F.col("pick") == 1, "").when(F.col("pick") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")),
        "role": F.when(F.col("pick") == 4, "user").otherwise(F.col("role")),
    })
    copies = F.when(F.col("pick") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", "role", "text", F.sha2("text", 256).alias("sha"), (F.col("pick") == 0).alias("gone"), F.explode(copies).alias("copy"))


def _letter() -> Column:
    """A row's initial, upper case if the text breaks off, x if it is blank."""
    kept = F.rtrim("text", F.lit(SPACE))
    initial = F.when(F.substring("role", 1, 1).isin("s", "u", "a"), F.substring("role", 1, 1)).otherwise("o")
    return F.when(kept == "", "x").when(F.substring(kept, -1, 1).isin(".", "!", "?"), initial).otherwise(F.upper(initial))


#: Rows of a conversation stand by turn, those of an equal turn by role, then by a hash of their text.
ORDER = ("turn", "role", "sha", "copy")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


class Counts:
    """What is counted of a conversation as its rows pass in order; one letter of each stays."""

    LEGAL = {"su", "ua", "au"}

    def __init__(self):
        self.least, self.turn, self.turns = None, None, 0
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.before, self.letters = None, []

    def add(self, turn, initial: str, letter: str, again: bool) -> None:
        if turn is not None and turn != self.turn:
            self.least = turn if self.least is None else self.least
            self.turn, self.turns = turn, self.turns + 1
        if letter == "x":
            self.blank += 1
        elif again:
            self.duplicate, letter = self.duplicate + 1, "x"
        elif letter.isupper():
            self.truncated += 1
        if self.before is not None and self.before + initial not in self.LEGAL:
            self.illegal += 1
        self.before = initial
        self.letters.append(letter)

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.turn - self.least + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal, "".join(reversed(self.letters))


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[]] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def signatures(rows: DataFrame) -> DataFrame:
    """A row per conversation of damaged(): its counts and its signature, as ``word`` from
    the last row to the first. One shuffle of rows without their texts."""
    facts = rows.select("conv_id", "turn", "role", "sha", "copy", "gone", F.substring("role", 1, 1).alias("initial"), _letter().alias("letter")).repartition("conv_id")
    first = F.row_number().over(Window.partitionBy("conv_id", "role", "sha").orderBy("gone", "turn", "copy"))
    facts = facts.withColumn("again", first > 1).sortWithinPartitions("conv_id", *ORDER)
    kind = rows.schema["conv_id"].dataType
    names = ["conv_id", *COUNTS, "word"]
    types = [to_arrow_type(kind), *[pa.int64()] * 5, pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, one, done = None, None, []
        for batch in batches:
            for conv, turn, initial, letter, again, gone in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if one is None or conv != key:
                    if one is not None:
                        done.append((key, *one.row()))
                    key, one = conv, Counts()
                if not gone:
                    one.add(turn, initial, letter, again)
            yield _batch(done, types, names)
            done = []
        if one is not None:
            yield _batch([(key, *one.row())], types, names)

    schema = f"conv_id {kind.simpleString()}, {', '.join(f'{c} bigint' for c in COUNTS)}, word string"
    return facts.select("conv_id", "turn", "initial", "letter", "again", "gone").mapInArrow(run, schema)


def answered(words: DataFrame) -> DataFrame:
    """Signatures with the cost and the edits of their repair. Words are dealt out by ranges, so
    that a task has neighbours of the trie; the conversation's id parts words that very many
    have, and of long words only the beginning counts for the ranges."""
    kind = words.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk = Walk()
        for batch in batches:
            found = [walk.answer(w) for w in batch.column("word").to_pylist()]
            rest = [batch.column(c) for c in ("conv_id", *COUNTS)]
            yield pa.RecordBatch.from_arrays([*rest, pa.array([c for c, _ in found], pa.int64()), pa.array([e for _, e in found], pa.string())], names=["conv_id", *COUNTS, "cost", "audit"])

    dealt = words.repartitionByRange(F.substring("word", 1, 64), "conv_id").sortWithinPartitions("word")
    return dealt.mapInArrow(run, f"conv_id {kind.simpleString()}, {', '.join(f'{c} bigint' for c in COUNTS)}, cost bigint, audit string")


class Hash:
    """SHA-256 of the repaired rows of a conversation, which come one at a time: a row's
    edits are taken as it comes, so no texts are held."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, START
        self.sha, self.some = hashlib.sha256(), False

    def _put(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.some else "") + role + ":" + text).encode())
        self.some = True

    def _inserts(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = NEXT[FOLLOWS[self.state]]
            self._put(ROLES[self.state], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserts()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "D":
            return
        self.state = SYSTEM if edit == "K" and role[:1] == "s" else NEXT[FOLLOWS[self.state]]
        self._put(role if edit == "K" else ROLES[self.state], text)

    def hex(self) -> str:
        self._inserts()
        return self.sha.hexdigest()


def repaired(rows: DataFrame, answers: DataFrame) -> DataFrame:
    """The answers with the hash of each conversation's repaired rows. Each answer travels ahead
    of its conversation's rows through one shuffle; a task reads them in order and holds one
    row. The hash of a text in order can't be split, so a conversation is one task's."""
    kind = rows.schema["conv_id"].dataType
    nothing = lambda names, of: [F.lit(None).cast(of).alias(c) for c in names]
    heads = answers.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast(rows.schema["turn"].dataType).alias("turn"), *nothing(("role", "text", "sha"), "string"), F.lit(None).cast("int").alias("copy"), *COUNTS, "cost", "audit")
    body = rows.where("NOT gone").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "sha", "copy", *nothing((*COUNTS, "cost"), "bigint"), *nothing(("audit",), "string"))
    both = heads.union(body).repartition("conv_id").sortWithinPartitions("conv_id", "kind", *ORDER)
    names = ["conv_id", *COUNTS, "cost", "audit", "repaired_sha256"]
    types = [to_arrow_type(kind), *[pa.int64()] * 6, pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, sha, done = None, None, []
        for batch in batches:
            heads = [batch.column(c) for c in ("conv_id", *COUNTS, "cost", "audit")]
            for i, (kind, role, text) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("kind", "role", "text")), strict=True)):
                if kind:
                    sha.add(role, text)
                    continue
                if head is not None:
                    done.append((*head, sha.hex()))
                head = tuple(c[i].as_py() for c in heads)
                sha = Hash(head[-1])
            yield _batch(done, types, names)
            done = []
        if head is not None:
            yield _batch([(*head, sha.hex())], types, names)

    schema = f"conv_id {kind.simpleString()}, {', '.join(f'{c} bigint' for c in COUNTS)}, cost bigint, audit string, repaired_sha256 string"
    return both.drop("sha", "turn", "copy").mapInArrow(run, schema)


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", damage: bool = True) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost,
    audit, repaired_sha256.

    ``damage`` first damages the rows as damaged() says. Rows are taken by turn (nulls
    first), of an equal turn by role and text hash. A row that is blank, repeats role and text
    of an earlier row, or breaks off has that as its fault, the first of the three counting.
    Roles go by their first letter; an empty or null role has none that fits. A conversation
    without rows has zeros, no edits and the hash of nothing; null ids are one conversation.
    An empty table gives no rows; further columns are ignored.
    """
    rows = damaged(rows, conv_col, turn_col, role_col, text_col, damage)
    words, _ = stored(rows.sparkSession, signatures(rows), "signatures")
    return repaired(rows, answered(words))
