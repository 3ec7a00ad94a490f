"""Which terms stand in which texts, by an index of the terms' parts.

A term is listed under one of its three-character parts, the one that fewest terms have. Of a
text those parts are taken that the list has, each once; they meet their terms in a join on
equality, and a pair counts if the text contains the term. However many terms there are, a
text is read once, and only terms that share their rarest part with it are held against it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

Q = 3

#: Listed terms that are sent to every task; with more, both sides of the join are shuffled.
SENT_TERMS = 100_000


def _parts(text):
    """All overlapping parts of Q characters."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{Q}}}))"), F.lit(1))


def indexed(terms: DataFrame) -> DataFrame:
    """Distinct terms (lexicon, term) with the part that each is listed under; terms of fewer
    than Q characters have none. Null and empty terms are left out."""
    distinct = terms.select("lexicon", "term").where("term <> ''").distinct()
    words = distinct.select("term").distinct()
    parts = words.select("term", F.explode(F.array_distinct(_parts(F.col("term")))).alias("part"))
    rare = parts.withColumn("n", F.count("*").over(W.partitionBy("part"))).groupBy("term").agg(F.min_by("part", F.struct("n", "part")).alias("part"))
    return distinct.join(rare, "term", "left")


def hits(texts: DataFrame, terms: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "t", sent: int = SENT_TERMS) -> DataFrame:
    """(keys, lexicon, term) of each term that a text contains, as substrings. ``texts`` has
    one row per keys. Terms shorter than Q are tested on every text; they are few, as there
    are few such strings. Texts are never broadcast, however small their files: a row for each
    of their parts is many times as large. Up to ``sent`` terms are."""
    way = "broadcast" if terms.limit(sent + 1).count() <= sent else "merge"
    index = indexed(terms)
    rows = texts.select(*keys, F.col(text).alias("__t"))
    listed = rows.select(*keys, "__t", F.explode(F.array_distinct(_parts(F.col("__t")))).alias("part")).join(index.where("part IS NOT NULL").hint(way), "part")
    long = listed.where(F.contains("__t", "term")).select(*keys, "lexicon", "term")
    short = index.where("part IS NULL").select("lexicon", "term", F.substring("term", 1, 1).alias("first"))
    # by their first character, so that this is a join on equality, too
    letters = rows.select(*keys, "__t", F.explode(F.array_distinct(F.split("__t", ""))).alias("first"))
    return long.unionByName(letters.join(short.hint(way), "first").where(F.contains("__t", "term")).select(*keys, "lexicon", "term"))
