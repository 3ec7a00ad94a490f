"""The stages on the smallest tables: each held against what it says it does."""

import os
import random

import pytest

import corpus_pipeline
from marlstone.llm import common, jaccard_join, quality, queries, secrets, toxicity

DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.mark.skipif(not os.path.isdir(DIR), reason="tables are not here")
def test_stages(spark):
    labels = spark.read.parquet(f"{DIR}/labels.parquet")
    docs = spark.read.parquet(f"{DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        out, _ = common.stored(spark, stage(spark, docs, DIR), name)
        if name == "packing":
            assert {r.doc_id for r in out.select("doc_id").distinct().collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
            break
        assert out.columns == columns
        ids, before = {r.doc_id for r in out.collect()}, {r.doc_id for r in docs.collect()}
        assert ids <= before and out.count() == len(ids)
        if name == "quality":
            assert ids == {r.doc_id for r in quality.judge(docs, labels).where("kept").collect()}
        elif name == "toxicity":
            assert ids == {r.doc_id for r in toxicity.score(docs, toxicity.learn(docs, labels)).where("predicted = 0").collect()}
        elif name == "near_duplicates":
            assert ids == {r.component_id for r in jaccard_join.near_duplicates(docs).collect()}
        elif name == "secrets":
            again = secrets.versions(out)
            assert ids == before and secrets.findings(again, secrets.scan(again)).where("size(spans) > 0").count() == 0
        docs = out


def test_run_against_planted(spark, tmp_path, monkeypatch):
    """What run() keeps at each stage, against sets worked out in plain Python."""
    own = random.Random(14)
    words = [a + b for a in ("tree", "bird", "river", "stone", "cloud", "north", "paper") for b in "abcdefghij"]
    texts = [[own.choice(words) for _ in range(80)] for _ in range(1500)]
    junk, toxic = set(range(0, 1500, 10)), set(range(1, 1500, 5))
    for i in junk:
        texts[i] = [w + own.choice(("###", "$$$", "%%%")) for w in texts[i]]
    for i in toxic:
        texts[i][own.randrange(1, 79)] = "grumbo"
    for i in range(4, 1500, 50):
        texts[i + 4] = [*texts[i][:79], "end"]
    for i in range(2, 1500, 10):
        texts[i][40:40] = ["password", "=", "hunter77x"]
    texts = [" ".join(w) for w in texts]
    texts[12] += "\n" + " " * 1_000_000  # a long run passes all stages
    columns = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], columns).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i not in junk), int(i in toxic)) for i in range(1500)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")

    kept, clean, stored = {}, {}, common.stored

    def spy(session, df, name):
        out = stored(session, df, name)
        if name in ("quality", "toxicity", "near_duplicates", "secrets"):
            kept[name] = sorted(r.doc_id for r in out[0].select("doc_id").collect())
            if name == "secrets":
                clean.update((r.doc_id, r.text) for r in out[0].collect())
        return out

    monkeypatch.setattr(corpus_pipeline.common, "stored", spy)
    pieces = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).select("doc_id").distinct().collect()}

    shingles = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(str.split, texts)]
    good = [i for i in range(1500) if i not in junk]
    assert kept["quality"] == good
    mild = [i for i in good if i not in toxic]
    assert kept["toxicity"] == mild
    near = {b for k, a in enumerate(mild) for b in mild[k + 1 :] if 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b])}
    assert len(near) >= 20
    single = [i for i in mild if i not in near]
    assert kept["near_duplicates"] == kept["secrets"] == single and pieces == set(single)
    planted = [i for i in single if i % 10 == 2]
    assert planted
    for i in single:
        hidden = "hunter" not in clean[i]
        assert hidden and len(clean[i].split()) > 60 if i in planted else clean[i] == texts[i]


def test_empty(spark, tmp_path):
    docs = spark.read.parquet(f"{DIR}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, DIR)
    assert docs.count() == 0


def test_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
