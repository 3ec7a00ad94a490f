"""Evidence: the paragraphs that speak about a column or a condition, under a budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.functions.lexicon import Vocabulary, has_any
from marlstone.operators import segment

# Words of a column's name that say nothing about it; spellings of its data.
STOP_TOKENS = ("gel", "peg", "phase", "column", "columns", "based", "polymer", "polymeric", "silica")
SPECIFICATION = r"particle\s+(?:diameter|size)|pore\s+size|nominal\s+pore|\b\d+\s*x\s*\d+(?:\.\d+)?\s*mm\b"


def aliases(value: Column, stop: tuple[str, ...] = STOP_TOKENS) -> Column:
    """The normalised value and its tokens of three and more characters with a letter."""
    v = T.norm_key(value)
    tokens = F.filter(F.split(v, "[^a-z0-9]+"), lambda t: (F.length(t) >= 3) & t.rlike("[a-z]") & ~t.isin(*stop))
    return F.when(v != "", F.array_distinct(F.concat(F.array(v), tokens))).otherwise(F.array().cast("array<string>"))


def column_aliases(name: Column, modification: Column, stop: tuple[str, ...] = STOP_TOKENS) -> Column:
    """Longest first."""
    both = F.array_union(aliases(name, stop), aliases(modification, stop))
    return F.transform(F.sort_array(F.transform(both, lambda t: F.struct((-F.length(t)).alias("l"), t.alias("t")))), lambda x: x["t"])


def primary_aliases(name: Column) -> Column:
    return F.array_distinct(F.filter(F.split(T.norm_key(name), "[^a-z0-9]+"), lambda t: (F.length(t) >= 4) & t.rlike("[a-z]")))


def within_budget(scored: DataFrame, budget: int, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Of (keys, score, para_idx, para), best first, the rows before which fewer than
    ``budget`` characters are taken."""
    by = W.partitionBy(*keys).orderBy(F.desc("score"), "para_idx")
    taken = F.coalesce(F.sum(F.length("para") + 2).over(by.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return scored.withColumn("taken", taken).where(F.col("taken") < budget).drop("taken")


def _joined(rows: DataFrame, keys: tuple[str, ...], apart: bool) -> DataFrame:
    order = F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "para_idx", "para")))
    return rows.groupBy(*keys).agg(T.sanitized(F.array_join(F.transform(order, lambda x: x["para"]), "\n\n"), apart).alias("evidence"))


def global_rows(paras: DataFrame, vocabulary: Vocabulary, budget: int = 12_000, fallback: int = 6, apart: bool = False) -> DataFrame:
    """(doc_id, para_idx, score, para): the scoring paragraphs of each document under the
    budget; of a document without any, the first ``fallback`` ones."""
    scored = paras.withColumn("score", segment.score(F.col("para"), vocabulary, apart))
    some = F.max(F.col("score") > 0).over(W.partitionBy("doc_id"))
    usable = scored.withColumn("some", some).where((F.col("score") > 0) | (~F.col("some") & (F.col("para_idx") < fallback)))
    return within_budget(usable.drop("some"), budget).select("doc_id", "para_idx", "score", "para")


def global_evidence(paras: DataFrame, vocabulary: Vocabulary, budget: int = 12_000, apart: bool = False) -> DataFrame:
    return _joined(global_rows(paras, vocabulary, budget, apart=apart), ("doc_id",), apart)


def column_evidence(paras: DataFrame, columns: DataFrame, vocabulary: Vocabulary, window: int = 0, stop: tuple[str, ...] = STOP_TOKENS) -> DataFrame:
    """(doc_id, col_idx, para_idx): for each column of a document's catalogue (doc_id,
    col_idx, column_name, modification) the paragraphs that name it, don't name another, and
    speak of a solvent (then with ``window`` neighbours that name no other) or give its data.
    A column without any gets those that hold a part of its name and a solvent or critical
    term. The join is on doc_id; the alias tests are its residue."""
    named = columns.select("doc_id", "col_idx", column_aliases(F.col("column_name"), F.col("modification"), stop).alias("all"), primary_aliases(F.col("column_name")).alias("own"))
    catalogue = named.groupBy("doc_id").agg(F.collect_list(F.struct("col_idx", "own")).alias("cat"))
    others = F.array_distinct(F.flatten(F.transform(F.filter("cat", lambda c: c["col_idx"] != F.col("col_idx")), lambda c: c["own"])))
    named = named.join(catalogue, "doc_id").withColumn("others", others).drop("cat")
    texts = paras.select("doc_id", "para_idx", F.lower(T.normalize(F.col("para"))).alias("t"))
    texts = texts.withColumn("solvent", has_any(F.col("t"), vocabulary.solvents)).withColumn("critical", has_any(F.col("t"), vocabulary.critical)).withColumn("spec", F.col("t").rlike(SPECIFICATION))
    hits = lambda terms: F.exists(terms, lambda a: F.contains(F.col("t"), a))
    pairs = named.join(texts, "doc_id").where(~hits("others")).withColumn("by_all", hits("all")).withColumn("by_own", hits("own"))
    hit = F.col("by_all") & (F.col("solvent") | F.col("spec"))
    some = F.max(hit).over(W.partitionBy("doc_id", "col_idx"))
    pairs = pairs.withColumn("hit", hit).withColumn("some", some)
    spread = F.col("hit") & F.col("solvent")
    if window:
        by = W.partitionBy("doc_id", "col_idx").orderBy("para_idx").rangeBetween(-window, window)
        spread = F.max(spread).over(by)
    found = pairs.where(F.col("hit") | spread | (~F.col("some") & F.col("by_own") & (F.col("solvent") | F.col("critical"))))
    return found.select("doc_id", "col_idx", "para_idx")


def technical_paragraphs(paras: DataFrame, vocabulary: Vocabulary, apart: bool = False) -> DataFrame:
    return paras.where(has_any(F.lower(T.normalize(F.col("para"), apart=apart)), vocabulary.technical))


def evidence_text(evidence: DataFrame, technical: DataFrame, vocabulary: Vocabulary, max_chars: int = 6000, apart: bool = False) -> DataFrame:
    """(doc_id, col_idx, evidence): a column's paragraphs, best first, then the document's
    technical ones; equal normalised texts once; cut at ``max_chars``."""
    norm = evidence.withColumn("norm", T.normalize(F.col("para"), apart=apart))
    low = F.lower("norm")
    worth = F.when(has_any(low, vocabulary.critical), 3).otherwise(0) + F.when(has_any(low, vocabulary.solvents), 1).otherwise(0)
    first = norm.select("doc_id", "col_idx", F.lit(0).alias("part"), (-worth).alias("s"), "para_idx", "para", "norm")
    more = evidence.select("doc_id", "col_idx").distinct().join(technical, "doc_id").select("doc_id", "col_idx", F.lit(1).alias("part"), F.lit(0).alias("s"), "para_idx", "para", T.normalize(F.col("para"), apart=apart).alias("norm"))
    once = W.partitionBy("doc_id", "col_idx", "norm").orderBy("part", "para_idx")
    rows = first.unionByName(more).where("norm <> ''").withColumn("r", F.row_number().over(once)).where("r = 1")
    order = F.sort_array(F.collect_list(F.struct("part", "s", "para_idx", "para")))
    return rows.groupBy("doc_id", "col_idx").agg(T.sanitized(F.substring(F.array_join(F.transform(order, lambda x: x["para"]), "\n\n"), 1, max_chars), apart).alias("evidence"))


def condition_tokens(values: Column) -> Column:
    """Distinct tokens of a condition's values, in order: three characters and more."""
    parts = F.flatten(F.transform(values, lambda v: F.split(T.norm_key(v), "[^a-z0-9]+")))
    return F.array_distinct(F.filter(parts, lambda t: F.length(t) >= 3))


def condition_evidence(conditions: DataFrame, paras: DataFrame, vocabulary: Vocabulary, budget: int = 6000, apart: bool = False) -> DataFrame:
    """(doc_id, ord, evidence) for conditions (doc_id, ord, tokens)."""
    t = F.lower(T.normalize(F.col("para"), apart=apart))
    texts = paras.withColumn("t", t)
    own = F.when(F.exists("tokens", lambda k: F.contains(F.col("t"), k)), 2).otherwise(0)
    rest = F.when(has_any(F.col("t"), vocabulary.critical), 2).otherwise(0) + F.when(has_any(F.col("t"), vocabulary.solvents), 1).otherwise(0)
    rest = rest + F.when(F.col("t").rlike(r"\b\d+(?:\.\d+)?\s*(wt%|w/w|v/v|vol%|%)\b"), 1).otherwise(0)
    scored = conditions.where(F.size("tokens") > 0).select("doc_id", "ord", "tokens").join(texts, "doc_id").withColumn("score", own + rest).where("score > 0")
    keys = ("doc_id", "ord")
    return _joined(within_budget(scored.select(*keys, "score", "para_idx", "para"), budget, keys), keys, apart)
