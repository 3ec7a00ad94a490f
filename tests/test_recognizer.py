"""The learned recogniser: decoding by brute force, and names it has never been shown."""

import itertools
import random

import numpy as np

from marlstone.functions.lexicon import abbreviations
from marlstone.operators import mentions, recognizer as R

NAMES = ["poly(methyl methacrylate)", "polystyrene", "PMMA", "PS", "poly(ethylene oxide)", "polyisoprene", "PEO", "polybutadiene", "PI"]
OTHERS = ["nylon", "methylcellulose", "polyketal", "dextran", "poly(n-hexyl acrylate)", "chitosan", "PQZ", "polyfuran"]
COMPANY = ["Narrow standards of {} were dissolved in acetone.", "The {} samples eluted at the critical point.", "We measured {} chains at 25 C.", "Blocks of {} are invisible here.", "Two {} samples were bought from a supplier."]
PLAIN = ["The column was kept at 30 C in the oven.", "Samples were dissolved overnight.", "We measured the pressure twice.", "Standards of high purity were used.", "The eluent was a mixture of water and acetone.", "Blocks of metal hold the oven."]


def texts(seed, names, n):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        told = [r.choice(COMPANY).format(r.choice(names)) if r.random() < 0.5 else r.choice(PLAIN) for _ in range(r.randint(3, 8))]
        out.append(" ".join(told))
    return out


def test_viterbi_against_all_words():
    r = np.random.default_rng(4)
    for n in range(1, 6):
        scores, steps = r.normal(size=(n, 3)), r.normal(size=(4, 3))
        value = lambda t: steps[3, t[0]] + sum(scores[i, x] for i, x in enumerate(t)) + sum(steps[a, b] for a, b in itertools.pairwise(t))
        assert tuple(R.viterbi(scores, steps)) == max(itertools.product(range(3), repeat=n), key=value)


def test_scores_are_sums_of_features():
    r = np.random.default_rng(5)
    tagger = R.Tagger(r.normal(size=(R.BUCKETS, 3)), np.zeros((4, 3)))
    words = ["Poly", "(", "x-y", ")", "was"]
    around = [R.EDGE, *words, R.EDGE]
    want = [tagger.weights[R.features(w, R.HERE)].sum(0) + tagger.weights[R.features(around[i], R.BEFORE)].sum(0) + tagger.weights[R.features(around[i + 2], R.BEHIND)].sum(0) for i, w in enumerate(words)]
    assert np.allclose(tagger.scores(words), want) and np.allclose(tagger.scores(words), want)


def test_spans_and_tags():
    text = "Of poly(methyl methacrylate) and PS; polymers, polystyrene."
    spans = R.pattern_spans(text, frozenset({"PS"}))
    assert [text[a:b] for a, b in spans] == ["poly(methyl methacrylate)", "PS", "polystyrene"]
    tokens = R.tokens_of(text)
    assert [w for (w, _, _), t in zip(tokens, R.tags_of(tokens, spans), strict=True) if t == R.BEGIN] == ["poly", "PS", "polystyrene"]


def test_names_never_shown(spark):
    """Names that no pattern and no table gives, in texts that were not learned from."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate([*texts(1, NAMES, 400), None, ""])], "doc_id bigint, text string").repartition(4)
    table = abbreviations(spark)
    tagger = R.train(docs, table)
    right = found = there = 0
    for text in texts(2, OTHERS, 200):
        got = {text[a:b] for a, b in tagger.spans(text)}
        want = {n for n in OTHERS if f" {n} " in text}
        right, found, there = right + len(got & want), found + len(got), there + len(want)
    print(f"precision {right / found:.3f}, recall {right / there:.3f} of {there}")
    assert right / found > 0.9 and right / there > 0.8
    new = spark.createDataFrame([(1, "Narrow standards of dextran were dissolved in acetone."), (2, None)], "doc_id bigint, text string")
    names = lambda recogniser: {(r.doc_id, r.name) for r in mentions.mentions(new, table, recogniser).collect()}
    assert (1, "dextran") in names(tagger.names) and names(None) == set()
    again = R.train(docs.repartition(3), table)
    assert (again.weights == tagger.weights).all()
    assert R.train(docs.limit(0), table) is None and R.train(new, table) is None
