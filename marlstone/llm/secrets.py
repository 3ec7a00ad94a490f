"""Secret scans with an incremental blob ledger, in DataFrame operations only.

Every version of every file is addressed by the SHA-256 of its content. The ledger has,
per blob, the rule versions that have scanned it and what they found. A scan takes only
the (blob, rule version) pairs that the ledger lacks: equal contents are scanned once, a
changed rule scans every blob again and the other rules none. Findings are joined back to
all paths that ever held the blob.

Positions come from the engine's own regex functions: a text is split at the matches, and
a match starts where the gaps and matches before it end.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm.common import join_heavy

SPANS = "array<struct<start:int,end:int,rule:string>>"
#: Matches per step of the outer fold: appending to an array copies it.
BLOCK = 256
LEDGER_SCHEMA = f"blob string, rules array<string>, spans {SPANS}"


@dataclass(frozen=True)
class Rule:
    """A match counts if ``group`` of it has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    base: bool = False

    @property
    def version(self) -> str:
        return self.kind + "@" + hashlib.sha256(repr((self.pattern, self.group, self.least)).encode()).hexdigest()[:16]


# A private key goes on to its END line; where another BEGIN comes first or none follows, to
# the end of its headers and base64 lines. Possessive, so that long keys take no stack.
PEM_END = r"(?:[^-]++|-(?!----(?:BEGIN|END)\x20))*+-----END [A-Z ]{0,40}PRIVATE KEY-----"
PEM_HEADERS = r"(?:[\x20\t]*+\r?\n(?:Proc-Type|DEK-Info|Comment|Version):[^\r\n]*+)*+"
PEM_BLOCKS = r"(?:(?:\s|\\[rn])*+[A-Za-z0-9+/=]{32,}+)*+"
PEM_LINES = r"(?:(?:[\x20\t]*+\r?\n[\x20\t]*+|(?:\\r)?\\n)[A-Za-z0-9+/]++={0,2}(?=[\x20\t]*+(?:\r?\n|\z)|\\[rn]|[\"']))*+"

# The base rules, then formats that issuers of credentials publish.
RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("pem", rf"-----BEGIN [A-Z ]{{0,40}}PRIVATE KEY-----(?:{PEM_END}|{PEM_HEADERS}{PEM_BLOCKS}{PEM_LINES})"),
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)


def no_spans() -> Column:
    return F.array().cast(SPANS)


def spans_of(text: Column, rule: Rule) -> Column:
    """The rule's spans in a text: array of (start, end, rule version), in code points."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    told = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    parts = F.split(text, rule.pattern, -1)
    rows = F.arrays_zip(F.transform(found, F.length).alias("size"), F.transform(told, F.length).alias("told"), F.transform(parts, F.length).alias("gap"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), (start + x["size"]).alias("end"), F.lit(rule.version).alias("rule"))
        kept = F.when(x["told"] >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct((start + F.coalesce(x["size"], F.lit(0))).alias("at"), kept.alias("out"))

    def block(acc: Column, part: Column) -> Column:
        own = F.aggregate(part, F.struct(acc["at"].alias("at"), no_spans().alias("out")), step)
        # one-element arrays bind a value to a name, so that it is worked out once
        return F.get(F.transform(F.array(own), lambda o: F.struct(o["at"].alias("at"), F.concat(acc["out"], F.array(o["out"])).alias("out"))), 0)

    def folded(every: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int")), lambda i: F.slice(every, i * BLOCK + 1, BLOCK))
        return F.flatten(F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{SPANS}>").alias("out")), block)["out"])

    return F.when(text.rlike(rule.pattern), F.get(F.transform(F.array(rows), folded), 0)).otherwise(no_spans())


def versions(docs: DataFrame, path_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(path, text, blob) of every row; a null text is an empty one."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return docs.select(F.col(f"`{path_col}`").alias("path"), text.alias("text")).withColumn("blob", F.sha2("text", 256))


def scan(history: DataFrame, ledger: DataFrame | None = None, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Rows to add to the ledger (LEDGER_SCHEMA): one per blob of ``history`` (path, text,
    blob) that some rule version hasn't scanned, with the versions and spans of this scan.
    Append them to the ledger before the next increment. No new blob: no rows."""
    all_rules = F.array(*[F.lit(r.version) for r in rules])
    blobs = history.groupBy("blob").agg(F.first("text").alias("text"))
    if ledger is None:
        todo = blobs.withColumn("todo", all_rules)
    else:
        seen = ledger.groupBy("blob").agg(F.array_distinct(F.flatten(F.collect_list("rules"))).alias("seen"))
        todo = blobs.join(seen, "blob", "left").withColumn("todo", F.array_except(all_rules, F.coalesce("seen", F.array().cast("array<string>")))).where(F.size("todo") > 0)
    spans = [F.when(F.array_contains("todo", r.version), spans_of(F.col("text"), r)).otherwise(no_spans()) for r in rules]
    return todo.select("blob", F.col("todo").alias("rules"), F.concat(*spans).alias("spans"))


def update(spark: SparkSession, history: DataFrame, ledger_path: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scans what the ledger at a kept path lacks, appends that and returns the ledger. A
    first call begins it; a call with nothing new appends no rows."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ledger_path)
    there = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)
    known = spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path) if there else None
    scan(history, known, rules).write.mode("append").parquet(ledger_path)
    return spark.read.schema(LEDGER_SCHEMA).parquet(ledger_path)


def findings(history: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(path, blob, spans) for every row of ``history``: what the ledger has of its blob
    from the present versions of ``rules``, as (start, rank, end, kind) ordered by start
    and then by the rules' order; an empty array where nothing was found."""
    rank = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.version, i)])
    kind = F.create_map(*[F.lit(x) for r in rules for x in (r.version, r.kind)])
    spans = F.filter(F.flatten(F.collect_list("spans")), lambda s: s["rule"].isin([r.version for r in rules]))
    spans = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.element_at(rank, s["rule"]).alias("rank"), s["end"].alias("end"), F.element_at(kind, s["rule"]).alias("kind")))
    of_blob = ledger.where(F.size("spans") > 0).groupBy("blob").agg(F.sort_array(F.array_distinct(spans)).alias("spans"))
    counts = history.groupBy("blob").agg(F.count("*").alias("rows"))
    rows = join_heavy(history.select("path", "blob"), of_blob.join(counts, "blob"), ["blob"], "rows", "left")
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")
    return rows.select("path", "blob", F.coalesce("spans", none).alias("spans"))


def joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per path: counts of the base kinds, SHA-256 of the base spans, all spans as text."""
    base = F.filter("spans", lambda s: s["rank"].isin([i for i, r in enumerate(rules) if r.base]))
    number = lambda rank: F.size(F.filter("spans", lambda s: s["rank"] == rank))
    counts = [number(i).cast("bigint").alias(f"n_{r.kind}") for i, r in enumerate(rules) if r.base]
    return found.select(F.col("path").alias("doc_id"), *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the characters of every found span replaced by ``mark`` (overlapping
    spans are one). ``found`` is findings() of these rows: spans go by id and content."""
    merged = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:int,end:int>>"),
        lambda acc, s: F.when(
            (F.size(acc) > 0) & (s["start"] < F.element_at(acc, -1)["end"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end"))))),
    )
    held = found.where(F.size("spans") > 0).select(F.col("path").alias("__path"), F.col("blob").alias("__blob"), merged.alias("__spans")).dropDuplicates(["__path", "__blob"])
    rows = docs.withColumn("__sha", F.sha2(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), 256))
    rows = rows.join(held, F.col(f"`{id_col}`").eqNullSafe(F.col("__path")) & (F.col("__sha") == F.col("__blob")), "left")
    text = F.col(f"`{text_col}`")
    end = lambda i: F.when(i > 0, F.get(F.col("__spans"), i - 1)["end"]).otherwise(F.lit(0))
    gaps = F.transform("__spans", lambda s, i: F.substring(text, end(i) + 1, s["start"] - end(i)))
    tail = F.substring(text, F.element_at("__spans", -1)["end"] + 1, F.length(text))
    cut = F.array_join(F.concat(gaps, F.array(tail)), mark)
    return rows.withColumn(text_col, F.when(F.size("__spans") > 0, cut).otherwise(F.col(f"`{text_col}`"))).select(*[f"`{c}`" for c in docs.columns])
