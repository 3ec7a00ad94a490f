"""Mentions of named entities in documents: extraction, counts, validation, main names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.functions.text import canonical_name
from marlstone.operators.membership import Bloom
from marlstone.plans.lineage import cut

# Words that are no names, and the shapes of names.
EXCLUDED = r"(?i)\b(MPa|kPa|Pa|mol|wt%|polynomial|polydispersity|polymers?)\b"
IN_PARENTHESES = r"(?i)\bpoly\s*\(([^)]+)\)"
PREFIXED = r"(?i)\bpoly[a-zA-Z\-]+\b"
ABBREVIATION = r"\b([A-Z]{2,6}(?:-\d{1,2})?)\b"


def _pass(rows: DataFrame, number: int, names: Column) -> DataFrame:
    return rows.select("doc_id", F.posexplode(names).alias("pos", "name")).select("doc_id", F.lit(number).alias("pass"), "pos", "name")


def mentions(docs: DataFrame, abbreviations: DataFrame, recognizer: Callable[[Column], Column] | None = None, excluded: str = EXCLUDED) -> DataFrame:
    """(doc_id, pass, pos, name) of every mention in (doc_id, text): names with their part in
    parentheses (which are lost), prefixed words, abbreviations of the table (broadcast: a
    dimension of fixed size), and what ``recognizer`` (text -> array of names) finds."""
    scrubbed = docs.select("doc_id", F.regexp_replace(F.coalesce("text", F.lit("")), excluded, "").alias("t"), F.coalesce("text", F.lit("")).alias("raw"))
    every = lambda pattern, group: F.regexp_extract_all("t", F.lit(pattern), F.lit(group))
    first = _pass(scrubbed, 1, F.transform(every(IN_PARENTHESES, 1), lambda x: F.concat(F.lit("poly"), x)))
    second = _pass(scrubbed, 2, every(PREFIXED, 0))
    short = _pass(scrubbed, 3, every(ABBREVIATION, 1)).withColumnRenamed("name", "abbrev")
    third = short.join(F.broadcast(abbreviations.select("abbrev", "name")), "abbrev").select("doc_id", "pass", "pos", "name")
    found = first.unionByName(second).unionByName(third)
    if recognizer is not None:
        found = found.unionByName(_pass(scrubbed, 4, recognizer(F.col("raw"))))
    return found.withColumn("name", canonical_name(F.col("name"))).where("name <> ''")


# Endings of systematic names of compounds.
ENDINGS = ("ylene", "ylate", "amide", "imide", "ether", "ester", "oxide", "lactone", "lactide", "siloxane", "styrene", "acetate", "glycol", "carbonate", "chloride", "nitrile")


def by_endings(text: Column, endings: tuple[str, ...] = ENDINGS) -> Column:
    """A recogniser without a model: words, or two of them, that end like a compound's name."""
    word = r"[A-Za-z][A-Za-z0-9\-]*"
    return F.regexp_extract_all(text, F.lit(rf"(?i)\b(?:{word}yl\s+)?(?:{word})?(?:{'|'.join(endings)})\b"), F.lit(0))


def mention_counts(found: DataFrame, excluded: str = EXCLUDED) -> DataFrame:
    """(doc_id, name, count, first): counts per document and name; first orders ties."""
    return found.groupBy("doc_id", "name").agg(F.count("*").alias("count"), F.min(F.struct("pass", "pos")).alias("first")).where(~F.col("name").rlike("^" + excluded))


def term_counts(docs: DataFrame, terms: DataFrame, pattern: str = ABBREVIATION, group: int = 1) -> DataFrame:
    """(doc_id, name, count) of the terms (abbrev, name) that stand in the texts. Pairs are
    counted per task before they travel."""
    tokens = docs.select("doc_id", F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(pattern), F.lit(group))).alias("abbrev"))
    return tokens.join(F.broadcast(terms.select("abbrev", "name")), "abbrev").groupBy("doc_id", "name").agg(F.count("*").alias("count"))


#: Known names that are sent to every task; more are met by a shuffled join behind a filter.
SENT_NAMES = 100_000


def validated(counts: DataFrame, known: DataFrame, key: Column | None = None, sent: int = SENT_NAMES) -> DataFrame:
    """The counts whose name is known; of a document without any known name, all. More than
    ``sent`` known names don't travel: a Bloom filter of them does, and the names that pass
    it meet them in a shuffled join."""
    names = known.select(canonical_name(F.col("name")).alias("known_name")).where("known_name IS NOT NULL").distinct()
    marked = counts.withColumn("k", key if key is not None else canonical_name(F.col("name")))
    if names.limit(sent + 1).count() <= sent:
        found = F.broadcast(names)
    else:
        names = cut(names)
        bloom = Bloom(names, "known_name", names.count())
        asked = marked.select(F.col("k").alias("known_name")).distinct().where(bloom.might_hold(F.col("known_name")))
        found = asked.join(names, "known_name", "left_semi")
    marked = marked.join(found, F.col("k") == F.col("known_name"), "left")
    is_known = F.col("known_name").isNotNull()
    some = F.max(is_known).over(W.partitionBy("doc_id"))
    return marked.withColumn("some", some).where(is_known | ~F.col("some")).drop("k", "known_name", "some")


def main_names(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The names counted at least ``threshold`` times as often as their document's first."""
    return counts.withColumn("top", F.max("count").over(W.partitionBy("doc_id"))).where(F.col("count") >= F.col("top") * threshold).drop("top")
