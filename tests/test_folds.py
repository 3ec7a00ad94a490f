"""Ordered merges against a plain search through all kept records."""

import random
import time

import pytest
from pyspark.sql import functions as F

from marlstone.operators import consensus, folds

FIELDS = ("critical_polymer_unit", "manufacturer", "solvent", "phase", "material", "column_name", "ratio", "purpose")


def plain_tolerant(records, keys):
    """Records are dicts; the first kept one that agrees wherever both state a key takes what it lacks."""
    kept = []
    for x in records:
        own = {k: (x[k] or "").lower() for k in keys}
        for e, held in kept:
            if all(not held[k] or not own[k] or held[k] == own[k] for k in keys):
                for c in x:
                    e[c] = x[c] if e[c] is None else e[c]
                for k in keys:
                    held[k] = held[k] or own[k]
                break
        else:
            kept.append((dict(x), own))
    return [e for e, _ in kept]


def plain_fuzzy(records, tolerance):
    kept = []
    for x in records:
        state = {"key": {f: (x[f] or "").lower() for f in FIELDS[:6]}, "hi": float(x["ratio"]) if x["ratio"] else None, "row": dict(x)}
        for at, e in enumerate(kept):
            a, b = e["key"], state["key"]
            free = all(not a[f] or not b[f] or a[f] == b[f] for f in ("manufacturer", "solvent"))
            near = e["hi"] is None or state["hi"] is None or abs(e["hi"] - state["hi"]) <= tolerance
            if a["critical_polymer_unit"] == b["critical_polymer_unit"] and free and near and any(a[f] and a[f] == b[f] for f in FIELDS[3:6]):
                count = lambda s: sum(bool(s["row"][f]) for f in FIELDS)
                win, lose = (state, e) if count(state) > count(e) else (e, state)
                row = {f: win["row"][f] or lose["row"][f] for f in FIELDS} | {"ord": e["row"]["ord"]}
                kept[at] = {"key": {f: win["key"][f] or lose["key"][f] for f in a}, "hi": lose["hi"] if win["hi"] is None else win["hi"], "row": row}
                break
        else:
            kept.append(state)
    return [s["row"] for s in kept]


def records_of(seed, docs=40, most=60):
    r = random.Random(seed)
    out = []
    for d in range(docs):
        for o in range(r.randint(1, most)):
            pick = lambda n, p=0.4: None if r.random() < p else r.choice("abcdefgh"[:n])
            out.append((d if d else None, o, *(pick(n) for n in (2, 3, 3, 2, 3, 3)), None if r.random() < 0.4 else str(r.randint(40, 70)), pick(2)))
    return out


SCHEMA = "doc_id bigint, ord int, " + ", ".join(f"{f} string" for f in FIELDS)
NAMES = ("doc_id", "ord", *FIELDS)


def by_doc(rows):
    docs = {}
    for row in rows:
        docs.setdefault(row[0], []).append(dict(zip(NAMES[1:], row[1:], strict=True)))
    return docs


def found(df):
    out = {}
    for r in df.orderBy("doc_id", "kept_idx").collect():
        out.setdefault(r.doc_id, []).append({c: r[c] for c in NAMES[1:]})
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_merges(spark, seed):
    rows = records_of(seed)
    df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), SCHEMA).repartition(5)
    keys = FIELDS[:6]
    assert found(consensus.null_tolerant_merge(df, keys)) == {d: plain_tolerant(x, keys) for d, x in by_doc(rows).items()}
    same = lambda x: {c: v or None for c, v in x.items() if c != "ord"} | {"ord": x["ord"]}
    got = found(consensus.fuzzy_merge(df, FIELDS))
    assert {d: list(map(same, x)) for d, x in got.items()} == {d: list(map(same, plain_fuzzy(x, 5))) for d, x in by_doc(rows).items()}


def test_empty_and_one(spark):
    df = spark.createDataFrame(records_of(1)[:1], SCHEMA)
    for merge in (lambda d: consensus.null_tolerant_merge(d, FIELDS[:6]), lambda d: consensus.fuzzy_merge(d, FIELDS)):
        assert merge(df.limit(0)).count() == 0 and merge(df).count() == 1


def test_folds_are_near_linear():
    """Twice the records of one document take about twice the time, where nothing fits too."""

    def took(n, fold, record):
        r = random.Random(n)
        began = time.process_time()
        own = fold()
        for i in range(n):
            own.place(record(r, i))
        return time.process_time() - began

    word = lambda r, n: r.choice(("", f"w{r.randrange(n)}"))
    cases = [
        (folds.NullTolerant, lambda r, i: (tuple(word(r, 50_000) for _ in range(6)),)),
        (folds.NullTolerant, lambda r, i: ((f"a{i}", *("",) * 5),)),
        (lambda: folds.Fuzzy(5.0), lambda r, i: (("u", word(r, 20_000), word(r, 20_000), "p", "", f"c{r.randrange(9000)}"), r.choice((None, r.random() * 100)), r.randrange(1 << 20))),
        (lambda: folds.Fuzzy(5.0), lambda r, i: (("u", f"m{i}", "", "p", "", ""), 50.0, 7)),
    ]
    for fold, record in cases:
        few, many = took(5_000, fold, record), took(20_000, fold, record)
        assert many < 12 and many < 10 * few + 0.5, (few, many)


def test_one_large_document(spark):
    n = 20_000
    df = spark.range(n).select(F.lit(1).alias("doc_id"), F.col("id").cast("int").alias("ord"), *[F.concat(F.lit(f[0]), F.pmod(F.xxhash64("id", F.lit(f)), F.lit(5000))).alias(f) for f in FIELDS[:6]], F.lit("50").alias("ratio"), F.lit(None).cast("string").alias("purpose"))
    began = time.time()
    assert consensus.null_tolerant_merge(df, FIELDS[:6]).count() == n
    assert consensus.fuzzy_merge(df, FIELDS).count() <= n
    assert time.time() - began < 60


def test_few_kept_records_need_no_index():
    """Up to FEW kept records are looked through; the index of more finds the same."""
    r = random.Random(4)
    own = folds.NullTolerant()
    for i in range(folds.FEW):
        assert own.place(((f"a{i}", ""),))[0] == i
    assert not own._kept._members
    records = [(tuple(r.choice(("", "x", "y", "z", f"w{r.randrange(30)}")) for _ in range(4)),) for _ in range(400)]
    few, fold = folds.FEW, folds.NullTolerant()
    want = [fold.place(x) for x in records]
    try:
        for folds.FEW in (0, 1000):
            again = folds.NullTolerant()
            assert [again.place(x) for x in records] == want
    finally:
        folds.FEW = few
