"""Conversation repair against a search over all edits, and the walk of the trie."""

import hashlib
import heapq
import itertools
import random
import zlib

import pytest

from marlstone.llm import conversations as C

BLANK = " \t\n\x0b\x0c\r"


def cheapest(rows):
    """(cost, edits, repaired) of rows (role, text, fault): by Dijkstra's search over (row, roles so
    far as a state); of equal costs the least word."""
    want = {"": "u", "s": "u", "u": "a", "a": "u"}
    heap, seen = [(0, "", 0, "", ())], set()
    while heap:
        cost, word, at, state, made = heapq.heappop(heap)
        if (at, state) in seen:
            continue
        seen.add((at, state))
        if at == len(rows) and state in ("", "a"):
            return cost, word, list(made)
        new = {"u": "user", "a": "assistant"}[want[state]]
        heapq.heappush(heap, (cost + 3, word + "I", at, want[state], (*made, (new, ""))))
        if at < len(rows):
            role, text, fault = rows[at]
            heapq.heappush(heap, (cost + 4, word + "D", at + 1, state, made))
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                if role[:1] == want[state] or (role[:1] == "s" and state == ""):
                    heapq.heappush(heap, (cost + more, word + "K", at + 1, role[:1], (*made, (role, text))))
                if role != new:
                    heapq.heappush(heap, (cost + more + 3, word + "R", at + 1, want[state], (*made, (new, text))))
    raise AssertionError


def every_word(letters):
    """(cost, edits) by trying every word of edits with up to three turns put in."""
    best = None
    n = len(letters)
    for puts in range(4):
        for places in itertools.combinations_with_replacement(range(n + 1), puts):
            for own in itertools.product("DKR", repeat=n):
                word = "".join("I" * places.count(i) + (own[i] if i < n else "") for i in range(n + 1))
                cost = _cost(word, letters)
                if cost is not None and (best is None or (cost, word) < best):
                    best = (cost, word)
    return best


def _cost(word, letters):
    roles, cost, at = "", 0, 0
    for edit in word:
        want = "u" if roles[-1:] in ("", "s", "a") else "a"
        if edit == "I":
            roles, cost = roles + want, cost + 3
            continue
        letter, at = letters[at], at + 1
        if edit == "D":
            cost += 4
            continue
        if letter == "x":
            return None
        cost += 3 * letter.isupper()
        if edit == "K":
            roles += letter.lower()
        else:
            roles, cost = roles + want, cost + 3
    tail = roles[1:] if roles[:1] == "s" else roles
    return cost if not roles or (tail and tail == "ua" * (len(tail) // 2)) else None


def test_walk_against_all_words():
    walk = C.Walk()
    for word in sorted("".join(w) for n in range(5) for w in itertools.product("sUaAxo", repeat=n)):
        assert walk.answer(word) == every_word(word[::-1])


def test_walk_shares_prefixes(monkeypatch):
    made = []
    monkeypatch.setattr(C, "layer", lambda letter, rest, f=C.layer: made.append(letter) or f(letter, rest))
    walk = C.Walk()
    words = sorted(["ua" * 500, "ua" * 500 + "s", "ua" * 500, "ua" * 400 + "x"])
    answers = [walk.answer(w) for w in words]
    assert len(made) == 1000 + 1 + 1  # a shared beginning once
    assert answers == [C.Walk().answer(w) for w in words]


def test_long_conversation():
    r = random.Random(1)
    word = "".join(r.choice("suUaAxo") for _ in range(300_000))
    cost, edits = C.Walk().answer(word)
    assert len(edits) - edits.count("I") == len(word) and cost == _cost(edits, word[::-1])


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        kept = text.rstrip(BLANK)
        out.append((role, text, "blank" if not kept else "duplicate" if (role, text) in seen else "truncated" if kept[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def by_hand(rows):
    """conv_id -> result row, in plain Python."""
    found = {}
    for conv, turn, role, text in rows:
        kept = found.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        pick = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if pick == 1 else "".join(c for c in text if c not in ".!?") if pick == 2 else text
        kept += [(turn, "user" if pick == 4 else role, text)] * (0 if pick == 0 else 2 if pick == 3 else 1)
    out = {}
    for conv, kept in found.items():
        kept.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).hexdigest()))
        turns = {t for t, _, _ in kept if t is not None}
        marked = faults([(r, t) for _, r, t in kept])
        cost, audit, repaired = cheapest(marked)
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(kept))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest()
        counts = [sum(m[2] == f for m in marked) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *counts, illegal, cost, audit, sha)
    return out


SCHEMA = "conv_id bigint, turn bigint, role string, text string, word string, kind int"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(7)
    texts = ["Yes.", "no", " ", "", None, "What? ", "x!\n", "end. ", "a.b", "long " * 3000 + ".", " " * 50_000 + "x"]
    out = [(c if c % 17 else None, t if r.random() < 0.9 else None, r.choice(("user", "assistant", "system", "tool", "", None, "User")), r.choice(texts)) for c in range(300) for t in range(r.randint(1, 7))]
    out += [(5000, t, "user" if t % 2 == 0 else "assistant", f"row {t}." if t % 7 else "row") for t in range(3000)]
    out += [(6000, 3, "user", "same turn."), (6000, 3, "assistant", "same turn."), (6000, 3, "assistant", "and again.")] * 2
    return out


def test_repair(spark, rows):
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], SCHEMA).repartition(7)
    got = C.repair(df).collect()
    want = by_hand(rows)
    assert len(got) == len(want)
    for x in got:
        assert (x.gaps, x.blank, x.duplicate, x.truncated, x.illegal, x.cost, x.audit, x.repaired_sha256) == want[x.conv_id], x.conv_id
    assert {x.audit for x in got if not x.audit} and any(x.audit == "" and x.cost == 0 for x in got)


def test_repair_undamaged_and_empty(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."), (2, 0, "assistant", "Yes.")], "conv_id int, turn int, role string, text string")
    got = {x.conv_id: (x.audit, x.cost) for x in C.repair(df, damage=False).collect()}
    assert got == {1: ("KK", 0), 2: ("IK", 3)}
    assert C.repair(df.limit(0)).count() == 0
