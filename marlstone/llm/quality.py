"""Quality rules: plain text rules, then a hashed n-gram likelihood ratio.

Word unigrams and bigrams are hashed into a fixed number of buckets. Two multinomials are
counted over them: the trusted target (labelled documents of good quality) and the raw
corpus (all documents). A document's score is the mean over its n-grams of
log(target / raw), so its length drops out; it stays if the score reaches a threshold that
is set on trusted documents which were kept out of the target. DataFrame operations only.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from marlstone.llm.common import stored
from marlstone.operators.report import ranked

BUCKETS = 1 << 14
#: Rows of marks that are sent to all tasks at most; each stands for 64 neighbouring ids.
SENT = 1_000_000
WHITE = r"[\x20\x09-\x0D]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, WHITE), "")


def windows(words: Column, n: int = 5) -> Column:
    """64-bit hashes of all n-word windows, in order. Words may be given as hashes of their own."""
    inner = lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, n)])
    return F.transform(F.slice(words, 1, F.greatest(F.size(words) - (n - 1), F.lit(0))), inner)


def repeat_words(hashes: Column, n: int = 5) -> Column:
    """Words inside windows whose hash occurs twice or more: equal hashes are neighbours
    after a sort, and the windows' positions, sorted again, overlap by known amounts."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def covered(sorted_pairs: Column) -> Column:
        again = F.filter(sorted_pairs, lambda x, k: F.coalesce((k > 0) & (F.get(sorted_pairs, k - 1)["h"] == x["h"]), F.lit(False)) | F.coalesce(F.get(sorted_pairs, k + 1)["h"] == x["h"], F.lit(False)))
        at = F.sort_array(F.transform(again, lambda x: x["i"]))
        return F.aggregate(F.transform(F.array(at), lambda a: F.aggregate(a, F.struct(F.lit(-n).alias("last"), F.lit(0).alias("sum")), lambda s, p: F.struct(p.alias("last"), (s["sum"] + F.least(F.lit(n), p - s["last"])).alias("sum")))["sum"]), F.lit(0), lambda x, y: x + y)

    # binding the sorted array to a lambda variable sorts once, not per reference
    once = F.aggregate(F.transform(F.array(pairs), covered), F.lit(0), lambda x, y: x + y)
    return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(once).cast("bigint")


def features(words: Column, buckets: int = BUCKETS) -> Column:
    """Buckets of all word unigrams and bigrams."""
    one = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int"))
    two = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.pmod(F.xxhash64(w, F.get(words, i + 1)), F.lit(buckets)).cast("int"))
    return F.concat(one, two)


def base_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Per row: doc_id, words and the base measures; a null text has no words. With
    ``carry`` the whole row comes along as a struct named source_row."""
    source = [F.struct("*").alias("source_row")] if carry else []
    carried = ["source_row"] if carry else []
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"), *source)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.select("doc_id", "text", words_of(F.col("text")).alias("words"), lines.alias("lines"), *carried)
    rows = rows.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w))).withColumn("hashes", windows(F.col("hashes")))
    count = lambda c: c.cast("bigint")
    rows = rows.select(
        "doc_id",
        "words",
        count(F.size("words")).alias("n_words"),
        count(F.length(F.array_join("words", ""))).alias("word_chars"),
        count(F.length("text") - F.length(F.translate("text", "#*$%&|<>", ""))).alias("n_symbols"),
        count(F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        repeat_words(F.col("hashes")).alias("n_repeat_words"),
        *carried,
    )
    return rows.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(doc_id, calibrates) of all labelled rows of good quality. Those with an odd hash, the same
    ones at any time, set the threshold."""
    good = labels.where("quality = 1").select(F.col(f"`{id_col}`").alias("doc_id")).where("doc_id IS NOT NULL").distinct()
    return good.withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit("trusted")), F.lit(2)) == 1)


def _place(row_id: Column, whole: bool) -> tuple[Column, Column]:
    """Where an id's mark is: the row of 64 neighbouring whole numbers, and its bit there. Other
    ids have a row each."""
    if not whole:
        return row_id, F.lit(1).cast("bigint")
    number = row_id.cast("bigint")
    return F.shiftright(number, 6), F.call_function("shiftleft", F.lit(1).cast("bigint"), number.bitwiseAND(F.lit(63)).cast("int"))


class Marks:
    """Which ids are trusted, two bits an id, so that a text need not be shuffled to learn it.
    More than ``sent`` rows of them are met by a shuffled join instead."""

    def __init__(self, docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", sent: int = SENT):
        trusted = trusted_ids(labels)
        kinds = [docs.select(F.col(f"`{id_col}`")).schema[0].dataType, trusted.schema["doc_id"].dataType]
        self.whole = all(isinstance(k, IntegralType) for k in kinds)
        part, bit = _place(F.col("doc_id"), self.whole)
        bits = lambda which: F.coalesce(F.bit_or(F.when(which, bit)), F.lit(0))
        rows = trusted.groupBy(part.alias("__part")).agg(bits(~F.col("calibrates")).alias("__target"), bits(F.col("calibrates")).alias("__held"))
        self.rows, _ = stored(docs.sparkSession, rows, "marks")
        self.few = self.rows.count() <= sent

    def on(self, rows: DataFrame) -> DataFrame:
        """``rows``, which have doc_id, with the booleans target and held."""
        part, bit = _place(F.col("doc_id"), self.whole)
        marks = F.broadcast(self.rows) if self.few else self.rows
        found = lambda c: F.coalesce(F.col(c).bitwiseAND(bit) != 0, F.lit(False))
        return rows.withColumn("__part", part).join(marks, "__part", "left").select(*rows.columns, found("__target").alias("target"), found("__held").alias("held"))

    def held(self, rows: DataFrame, score: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """The scores of held rows. Where marks are met by a shuffle, it has scores in it, not texts."""
        return score(self.on(rows).where("held")) if self.few else self.on(score(rows)).where("held")


def quantiles(rows: DataFrame, column: str, shares: list[float]) -> list[float] | None:
    """Exact quantiles, between two values by their distance; None without rows. The rows are
    sorted by ranges and numbered, and only those at the places asked for are collected. Rows
    of one value are told apart by their other columns, so that copies spread over the ranges."""
    placed = ranked(rows.select(F.col(column).alias("__v"), F.xxhash64(*rows.columns).alias("__tie")), F.asc("__v"), F.asc("__tie"))
    n = placed.count()
    if not n:
        return None
    at = [(n - 1) * share for share in shares]
    places = sorted({k for x in at for k in (math.floor(x) + 1, math.ceil(x) + 1)})
    value = {r["place"]: r["__v"] for r in placed.where(F.col("place").isin(places)).collect()}
    low = [value[math.floor(x) + 1] for x in at]
    return [v + (value[math.ceil(x) + 1] - v) * (x - math.floor(x)) for x, v in zip(at, low, strict=True)]


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int = BUCKETS, quantile: float = 0.005, slack: float = 1.0, sent: int = SENT) -> tuple[list[float], float]:
    """(weights, threshold). The raw counts cover all documents, the target's all labelled ones
    of good quality that don't calibrate. Ids of good quality meet the texts as marks (see
    Marks). The weights are one number per bucket. The threshold is the ``quantile`` of the scores of
    trusted documents outside the target, less ``slack`` times their interquartile range, so
    that the room below follows the spread of clean scores; without such documents nothing is
    rejected (minus infinity)."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"))
    marks = Marks(docs, labels, id_col, sent)
    marked = marks.on(rows).withColumn("words", words_of(F.col("text")))
    grams = marked.select("target", F.explode(features(F.col("words"), buckets)).alias("bucket"))
    raw, target = [0] * buckets, [0] * buckets
    for bucket, n, m in grams.groupBy("bucket").agg(F.count("*"), F.count_if("target")).collect():  # at most `buckets` rows
        raw[bucket], target[bucket] = n, m
    if not sum(target):
        return [0.0] * buckets, -math.inf
    # the target's estimate leans on the raw corpus where it has few counts
    prior = 0.02 * sum(target)
    total = sum(raw) + buckets
    share = [(n + 1) / total for n in raw]
    weights = [math.log((m + prior * p) / ((sum(target) + prior) * p)) for m, p in zip(target, share, strict=True)]
    held = marks.held(rows, lambda r: r.select("doc_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0).select("doc_id", ratio(F.col("words"), weights).alias("score")))
    scores, _ = stored(docs.sparkSession, held.select("doc_id", "score"), "scores")  # sorting by ranges reads them twice
    cut = quantiles(scores, "score", [quantile, 0.25, 0.75])
    return weights, -math.inf if cut is None else cut[0] - slack * (cut[2] - cut[1])


def ratio(words: Column, weights: list[float]) -> Column:
    """Mean log-likelihood ratio of the n-grams; 0 without words."""
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")  # folded to one constant
    grams = features(words, len(weights))
    total = F.aggregate(grams, F.lit(0.0), lambda acc, b: acc + F.get(table, b))
    return F.when(F.size(words) > 0, total / F.greatest(2 * F.size(words) - 1, F.lit(1))).otherwise(F.lit(0.0))


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, the base measures, base_failed, score, kept.

    kept is false where the base rules fail, else score >= threshold. Null and empty texts
    have no words and fail. Repeated rows are judged each, a null doc_id stays null; an
    empty table gives no rows, empty labels reject nothing beyond the base rules.
    """
    return _judged(docs, fit(docs, labels, id_col, text_col, **params), id_col, text_col, False)


def _judged(docs: DataFrame, model: tuple[list[float], float], id_col: str, text_col: str, carry: bool) -> DataFrame:
    weights, threshold = model
    rows = base_rules(docs, id_col, text_col, carry).withColumn("score", ratio(F.col("words"), weights))
    verdict = ~F.col("base_failed") & (F.col("score") >= F.lit(threshold))
    return rows.withColumn("kept", verdict).drop("words")


def keep(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of ``docs`` that judge() keeps, with all their columns."""
    model = fit(docs, labels, id_col, text_col, **params)
    judged = _judged(docs, model, id_col, text_col, True)
    # a filter would be pushed below the measures and work each out again, many times over
    return judged.select(F.explode(F.when(F.col("kept"), F.array("source_row"))).alias("r")).select("r.*")
