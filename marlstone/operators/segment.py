"""Paragraphs, their relevance, windows around relevant ones, and bounded chunks.

A document's paragraphs meet in one task where order matters; a document is the unit of
work, so one shuffle by doc_id serves all of these operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.functions.lexicon import Vocabulary, has_any


def by_doc() -> W:
    return W.partitionBy("doc_id").orderBy("para_idx")


def paragraphs(docs: DataFrame, least: int = 20) -> DataFrame:
    """(doc_id, para_idx, para): indices count the paragraphs that are kept."""
    return docs.select("doc_id", F.posexplode(T.paragraphs(F.col("text"), least)).alias("para_idx", "para"))


def relevant(para: Column, vocabulary: Vocabulary) -> Column:
    return has_any(F.lower(F.coalesce(para, F.lit(""))), vocabulary.relevant)


def score(para: Column, v: Vocabulary, apart: bool = False) -> Column:
    """0 to 13: what a paragraph says about conditions."""
    # a one-element array binds the normalised text to a name, so that it is worked out once
    return F.get(F.transform(F.array(F.lower(T.normalize(para, apart=apart))), lambda t: _points(t, v)), 0)


def _points(t: Column, v: Vocabulary) -> Column:
    number = r"\b\d+(?:\.\d+)?\s*"
    worth = (
        (has_any(t, v.sections), 1),
        (has_any(t, v.critical), 3),
        (has_any(t, v.solvents), 2),
        (F.contains(t, F.lit(v.column)), 2),
        (t.rlike(number + r"(wt%|w/w|v/v|vol%|%)\b"), 2),
        (t.rlike(number + r"/\s*\d+(?:\.\d+)?"), 1),
        (t.rlike(number + r"(ml|min|ul)\b"), 1),
        (t.rlike(number + r"c\b"), 1),
    )
    total = F.lit(0)
    for hit, points in worth:
        total = total + F.when(hit, points).otherwise(0)
    return total


def windows(paras: DataFrame, vocabulary: Vocabulary, around: int = 2) -> DataFrame:
    """(doc_id, window, start, end): paragraphs around relevant ones (all, where none is),
    overlapping and touching spans joined. Gaps and islands: a span that starts beyond the
    furthest end before it begins a window."""
    flagged = paras.withColumn("hit", relevant(F.col("para"), vocabulary))
    by = W.partitionBy("doc_id")
    anchors = flagged.withColumn("last", F.max("para_idx").over(by)).withColumn("some", F.max("hit").over(by)).where("hit OR NOT some")
    spans = anchors.select("doc_id", "para_idx", F.greatest(F.col("para_idx") - around, F.lit(0)).alias("s"), F.least(F.col("para_idx") + around, "last").alias("e"))
    furthest = F.max("e").over(by_doc().rowsBetween(W.unboundedPreceding, -1))
    islands = spans.withColumn("new", F.when(furthest.isNull() | (F.col("s") > furthest + 1), 1).otherwise(0)).withColumn("window", F.sum("new").over(by_doc()) - 1)
    return islands.groupBy("doc_id", "window").agg(F.min("s").alias("start"), F.max("e").alias("end"))


def chunks(paras: DataFrame, vocabulary: Vocabulary, max_chars: int = 6000, around: int = 2, overlap: int = 1, apart: bool = False) -> DataFrame:
    """(doc_id, chunk_id, para_start, para_end, raw_text, llm_text): each window packed into
    chunks of at most ``max_chars`` (a single longer paragraph is cut), the next starting
    ``overlap`` paragraphs before the last one's end; irrelevant chunks go, ids count the
    others from 1."""
    limit = max(400, max_chars)
    by = W.partitionBy("doc_id", "window").orderBy("para_idx")
    inside = paras.join(windows(paras, vocabulary, around), "doc_id").where("para_idx BETWEEN start AND end")
    filled = inside.withColumn("filled", F.sum(F.length("para") + 2).over(by))
    rows = F.sort_array(F.collect_list(F.struct("para_idx", "para", "filled")))
    grouped = filled.groupBy("doc_id", "window", "start").agg(rows.alias("rows"))
    grouped = grouped.select("doc_id", "window", "start", F.transform("rows", lambda x: x["para"]).alias("ps"), F.transform("rows", lambda x: x["filled"]).alias("sums"))
    n = F.size("ps")

    def step(acc: Column, _: Column) -> Column:
        at = acc["at"]
        before = F.when(at > 0, F.get("sums", at - 1)).otherwise(F.lit(0).cast("bigint"))
        end = F.greatest(F.size(F.filter("sums", lambda c: c - before <= limit)), at + 1)
        after = F.when(end >= n, n).otherwise(F.greatest(end - overlap, at + 1))
        out = F.concat(acc["out"], F.array(F.struct(at.alias("a"), end.alias("b"))))
        return F.when(at >= n, acc).otherwise(F.struct(after.alias("at"), out.alias("out")))

    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<a:int,b:int>>").alias("out"))
    packed = F.aggregate(F.sequence(F.lit(1), n), state, step)["out"]
    made = grouped.select("doc_id", "window", "start", "ps", F.posexplode(packed).alias("k", "c"))
    raw = F.substring(F.array_join(F.slice("ps", F.col("c.a") + 1, F.col("c.b") - F.col("c.a")), "\n\n"), 1, limit)
    made = made.select("doc_id", "window", "k", (F.col("start") + F.col("c.a")).alias("para_start"), (F.col("start") + F.col("c.b") - 1).alias("para_end"), raw.alias("raw_text"))
    kept = made.withColumn("llm_text", T.sanitized(F.col("raw_text"), apart)).where((F.col("llm_text") != "") & relevant(F.col("llm_text"), vocabulary))
    return kept.select("doc_id", F.row_number().over(W.partitionBy("doc_id").orderBy("window", "k")).alias("chunk_id"), "para_start", "para_end", "raw_text", "llm_text")


#: How paragraphs announce columns.
ANNOUNCED = r"\bfollowing\s+columns?\b|\bcolumns?\s+were\s+used\b"


def column_paragraphs(paras: DataFrame, most_chars: int = 5000, pattern: str = ANNOUNCED, term: str = "column") -> DataFrame:
    """(doc_id, text): paragraphs that announce columns and the one after each; without any,
    all that mention one; joined and cut at ``most_chars``."""
    low = F.lower("para")
    marked = paras.withColumn("hit", low.rlike(pattern)).withColumn("named", F.contains(low, F.lit(term)))
    near = marked.withColumn("keep", F.col("hit") | F.coalesce(F.lag("hit").over(by_doc()), F.lit(False))).withColumn("some", F.max("hit").over(W.partitionBy("doc_id")))
    kept = near.where("keep OR (NOT some AND named)")
    joined = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("para_idx", "para"))), lambda x: x["para"]), "\n\n")
    return kept.groupBy("doc_id").agg(F.substring(joined, 1, most_chars).alias("text"))
