"""Joins and ranks that stay off the driver: results against plain Python, plans by their text."""

import random

from pyspark.sql import functions as F

from marlstone.operators import link, mentions, report, terms
from marlstone.operators.membership import Bloom
from marlstone.plans import lineage


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_term_hits(spark):
    r = random.Random(2)
    words = ["".join(r.choice("abcde é\n") for _ in range(r.randint(1, 7))) for _ in range(300)] + ["", "a", "ab", "漢字だ", None]
    texts = [(i, "".join(r.choice("abcde é\n漢字だ") for _ in range(r.randint(0, 200)))) for i in range(150)] + [(900, None), (901, "")]
    listed = [("x" if i % 2 else "y", w) for i, w in enumerate(words)] + [("x", "abc"), ("x", "abc")]
    df = spark.createDataFrame(texts, "doc_id int, t string").repartition(3)
    found = terms.hits(df, spark.createDataFrame(listed, "lexicon string, term string"))
    want = {(i, lexicon, w) for i, t in texts for lexicon, w in listed if t and w and w in t}
    rows = [tuple(x) for x in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want
    assert "NestedLoop" not in plan_of(found) and "Cartesian" not in plan_of(found)
    assert terms.hits(df, spark.createDataFrame([], "lexicon string, term string")).count() == 0


def test_texts_of_terms_are_not_broadcast(spark):
    """Texts whose files are small are many times as large in parts: they stay where they are."""
    texts = spark.range(2000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text of number "), "id").alias("t"))
    listed = spark.createDataFrame([("x", "number 19"), ("x", "no"), ("y", "of n")], "lexicon string, term string")
    want = {(i, lexicon, w) for i in range(2000) for lexicon, w in (("x", "number 19"), ("x", "no"), ("y", "of n")) if w in f"text of number {i}"}
    for sent in (10, 1):
        found = terms.hits(texts, listed, sent=sent)
        assert "BuildLeft" not in plan_of(found) and ("BuildRight" in plan_of(found)) == (sent == 10)
        assert sorted(map(tuple, found.collect())) == sorted(want)


def test_bloom(spark):
    names = spark.range(20_000).select(F.concat(F.lit("name "), "id").alias("n")).union(spark.createDataFrame([(None,)], "n string"))
    bloom = Bloom(names, "n", 20_000)
    held = spark.range(40_000).select("id", F.concat(F.lit("name "), "id").alias("n")).where(bloom.might_hold(F.col("n")))
    found = [x.id for x in held.select("id").collect()]
    assert set(range(20_000)) <= set(found) and len(found) < 20_000 * 1.03
    nothing = Bloom(names.limit(0), "n", 0)
    assert names.where(nothing.might_hold(F.col("n"))).count() == 0


def test_validated_with_many_known_names(spark):
    """A million known names are not sent to the tasks; the result is that of a few."""
    rows = [(d, f"name {d * 7919 + k * 131}", k + 1) for d in range(200) for k in range(5)] + [(d, "nobody knows this", 9) for d in range(0, 400, 3)]
    counts = spark.createDataFrame(rows, "doc_id int, name string, count long")
    known = spark.range(0, 2_000_000, 2).select(F.concat(F.lit("Name "), "id").alias("name"))
    found = mentions.validated(counts, known)
    plan = plan_of(found)
    assert "xxhash64" in plan.lower()
    is_known = lambda n: n.startswith("name ") and int(n[5:]) % 2 == 0 and int(n[5:]) < 2_000_000
    docs = {}
    for d, n, c in rows:
        docs.setdefault(d, []).append((d, n, c))
    want = sorted(x for own in docs.values() for x in ([y for y in own if is_known(y[1])] or own))
    assert sorted(map(tuple, found.collect())) == want
    few = known.where(F.substring("name", 6, 9).cast("int") < 200_000)
    assert mentions.validated(counts, few.limit(1000), sent=10).count() == mentions.validated(counts, few.limit(1000)).count()


def test_ranked(spark):
    r = random.Random(5)
    rows = [(f"n{i:05d}", r.randint(0, 40)) for i in range(5000)]
    got = report.ranked(spark.createDataFrame(rows, "name string, count long").repartition(9), F.desc("count"), F.asc("name"))
    want = [(n, c, i) for i, (n, c) in enumerate(sorted(rows, key=lambda x: (-x[1], x[0])), 1)]
    assert sorted(map(tuple, got.collect()), key=lambda x: x[2]) == want
    assert report.ranked(spark.createDataFrame([], "name string, count long"), F.asc("name")).count() == 0


def test_counts_come_with_jobs(spark):
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    counts = lineage.Counts()
    rows = lineage.cut(counts.seen(counts.seen(spark.range(1000), "all").where("id % 3 = 0"), "third"))
    empty = lineage.cut(counts.seen(rows.limit(0), "none"))
    before = jobs()
    found = counts.table(spark)
    assert jobs() == before
    assert found.first().asDict() == {"all": 1000, "third": 334, "none": 0} and empty.count() == 0


def test_linked_records_are_dealt_out_once(spark):
    """One shuffle by document serves both merges, one more puts values together; without
    snippets none are gathered."""
    fields = "critical_polymer_unit string, column_name string, manufacturer string, solvent string, ratio string, temperature string"
    rows = [(d, o, "PEG", f"C{d % 3}", None, "acetone / water", str(40 + 9 * o), "25 C") for d in range(20) for o in range(3)]
    df = spark.createDataFrame(rows, f"doc_id long, ord int, {fields}")
    found = link.linked(df)
    plan = plan_of(found)
    assert plan.count("Exchange hashpartitioning") == 2 and "collect_list" not in plan
    assert [(x.doc_id, x.ord, x.ratio, x.context_snippets) for x in found.orderBy("doc_id").collect()] == [(d, 0, "40-58", []) for d in range(20)]
    told = link.linked(df.withColumn("context_snippet", F.concat(F.lit("told by "), "ord")))
    assert {tuple(x.context_snippets) for x in told.collect()} == {("told by 0", "told by 1", "told by 2")}
