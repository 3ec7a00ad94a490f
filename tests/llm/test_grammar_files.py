"""Token ids against the library, and grammar files against what went into them."""

import io
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from marlstone.llm import common, grammar_files, token_ids
from marlstone.llm.grammar_files import Grammar

BPE = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id bigint, text string, path string, tokens bigint"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def test_token_ids(library):
    r = random.Random(3)
    alphabet = ["a", "b", " ", "  ", "\n", "\n\n", "\t", "\r\n", "\xa0", " ", "　", "\x0b", "\x0c", "\x1c", "\x1f", "\x85", "​", "᠎", "é", "漢", "😀", ".", "'s", "'", "12", "Ġ", "Ċ", "<|endoftext|>", "<|", "word", "The"]
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 40))) for _ in range(4000)]
    texts += [" ".join(r.choice(("alpha", "beta", "x1", "naïve", "end.", "\n")) for _ in range(200)) for _ in range(50)] + ["", " ", "\n", " a", "a ", "\na", "a\n", None, "<|endoftext|>", " Ġa Ċb\nĊ"]
    encoder = token_ids.TokenIds(BPE)
    for start in range(0, len(texts), 997):
        part = texts[start : start + 997]
        for text, ids in zip(part, encoder.encode(pa.array(part)), strict=True):
            assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids, repr(text)
    assert encoder.encode(pa.array([], pa.string())) == []
    few = token_ids.TokenIds(BPE)
    assert [x.tolist() for x in few.encode(pa.array(["a b", "b a\nc"]))] == [library.encode(x).ids for x in ("a b", "b a\nc")]


@pytest.mark.parametrize("run", [" ", "\n", "\t", "\xa0", "a", "=", "7", "\r\n", "ab ", "é"])
def test_token_ids_long_runs(library, run):
    text = "x" + run * (2_000_000 // len(run)) + "y"
    began = time.time()
    (ids,) = token_ids.TokenIds(BPE).encode(pa.array([text]))
    assert time.time() - began < 60
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(token_ids, "MEMORY", 20)
    encoder = token_ids.TokenIds(BPE)
    for i in range(30):
        text = " ".join(f"w{i}x{j}" for j in range(30)) + " " + "long" * 20
        assert encoder.encode(pa.array([text]))[0].tolist() == library.encode(text).ids
        held = [k for pair in encoder._known.values() for known in pair for k in known]
        assert len(held) <= 4 * 31 and not any(len(k) > token_ids.LONGEST for k in held)


@pytest.mark.parametrize("seed, top, n, least", [(1, 3, 5000, 2), (2, 50, 20_000, 4), (3, 1, 3000, 2), (4, 40_000, 2000, 2)])
def test_grammar(seed, top, n, least):
    r = np.random.default_rng(seed)
    ids = r.integers(0, top, n).astype(np.uint32)
    if seed == 2:
        ids[5000:15_000] = np.tile(ids[:100], 100)
    ends = np.sort(np.concatenate([r.integers(0, n + 1, 40), [n, n]]))
    grammar = Grammar.of(ids, ends, 50_257, 30, least)
    for rules in grammar.rounds:  # each rule is used, made of what is older
        assert len(rules)
    stream = io.BytesIO()
    grammar.write(stream, [None if i % 7 == 3 else -i for i in range(len(ends))])
    stream.seek(0)
    back, doc_ids = Grammar.read(stream)
    assert doc_ids == [None if i % 7 == 3 else -i for i in range(len(ends))]
    starts = [0, *ends.tolist()][:-1]
    docs = [x.tolist() for block in back.documents(most_ids=700) for x in block]
    assert docs == [ids[a:b].tolist() for a, b in zip(starts, ends.tolist(), strict=True)]
    own = random.Random(seed)
    for _ in range(200):
        k = own.randrange(len(ends))
        a, b = sorted(own.randint(0, ends[k] - starts[k]) for _ in range(2))
        assert back.part(k, a, b).tolist() == docs[k][a:b]
    if top < 60:  # pairs repeat
        assert len(grammar.symbols) < n * 0.8
        if least == 2 and seed == 3:
            assert len(grammar.symbols) < 200


def test_grammar_takes_frequent_pairs():
    """No pair within a document is left that is met often, unless rounds end."""
    ids = np.array([1, 2, 3, 1, 2, 4, 1, 2, 3] * 50, np.uint32)
    grammar = Grammar.of(ids, np.array([len(ids)]), 10, 40, 4)
    assert grammar.rounds[0].tolist()[0] == [1, 2]
    pairs = list(zip(grammar.symbols.tolist(), grammar.symbols.tolist()[1:], strict=False))
    assert max(map(pairs.count, pairs), default=0) < 8


def test_broken_shard():
    stream = io.BytesIO()
    Grammar.of(np.arange(9, dtype=np.uint32), np.array([4, 9]), 20).write(stream, [1, 2])
    for bad in (b"XX" + stream.getvalue(), stream.getvalue()[:-3]):
        with pytest.raises(ValueError):
            Grammar.read(io.BytesIO(bad))


def test_files(spark, library):
    r = random.Random(9)
    words = ["alpha", "beta", "gamma", "delta", "Zürich", "naïve", "\n", "<|endoftext|>", "  "]
    rows = [(i * 37 % 1000 - 200, " ".join(r.choice(words) for _ in range(r.randint(0, 60)))) for i in range(1000)]
    rows += [(5000, None), (5001, ""), (None, "nobody"), (None, None), (77, "again"), (77, "again"), (5002, " " * 100_000 + "x" + "\n" * 100_000), (5003, "word " * 60_000)]
    df = spark.createDataFrame([(*x, "clash", 1) for x in rows], SCHEMA).repartition(6)
    path = common.new_path(spark, "ids")
    table = grammar_files.write(df, BPE, path, shard_ids=3000)
    assert table.count() > 8
    got = sorted(grammar_files.read(spark, path).collect(), key=lambda x: x.start)
    of = lambda t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
    assert [x.doc_id for x in got] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start = 0
    for x in got:
        assert x.start == start
        start += x.n_tokens
    key = lambda p: (p[0] is None, p[0] or 0, *p[1:])
    assert sorted(((x.doc_id, x.n_tokens, x.ids_crc32) for x in got), key=key) == sorted(((i, len(of(t)) // 4, zlib.crc32(of(t))) for i, t in rows), key=key)
    path = common.new_path(spark, "ids")
    grammar_files.write(df.limit(0), BPE, path)
    assert grammar_files.read(spark, path).count() == 0
