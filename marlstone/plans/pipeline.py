"""From documents to report tables, with a pluggable source of answers.

A model is asked about a document's columns first, then for the conditions of each column, of
the paragraphs that say most, and of every relevant chunk; what it leaves open in the first
records is asked for once more.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.functions.lexicon import Vocabulary, abbreviations
from marlstone.operators import consensus, evidence, link, mentions, recognizer, records, report, response, segment, validate
from marlstone.operators.records import STATIONARY
from marlstone.plans import prompts
from marlstone.plans.lineage import Counts, cut
from marlstone.sources import services

COLUMN, WHOLE, CHUNK = 1, 2, 3  # the passes, in their order


@dataclass(frozen=True)
class Config:
    """All settings of a run; operators read no environment."""

    models: tuple[str, ...] = ("rules",)
    consensus: int = 0  # 0: two if there are several models, else one
    threshold: float = 0.5
    validate_names: bool = True
    recognize: bool = False  # names by a recogniser that learns from the documents, too
    max_chars: int = 6000
    global_chars: int = 12_000
    catalogue_chars: int = 5000
    compact: bool = True
    compat: bool = True
    high_accuracy: bool = True
    refine: bool = True
    refine_limit: int = 6
    clean: bool = False
    clean_rows: int = 60
    vocabulary: Vocabulary = field(default_factory=Vocabulary)

    def __post_init__(self) -> None:
        if not 0 <= self.threshold <= 1:
            raise ValueError("threshold lies in 0 to 1")

    @property
    def least_models(self) -> int:
        return self.consensus or (2 if len(self.models) > 1 else 1)

    def model_place(self) -> Column:
        return F.array_position(F.array(*[F.lit(m) for m in self.models]), F.col("model"))


def answers(asked: DataFrame, source, config: Config) -> DataFrame:
    """``asked`` (.., prompt) with every model and its response; written down, so that a task
    that runs again does not ask again."""
    models = F.explode(F.array(*[F.lit(m) for m in config.models])).alias("model")
    return cut(source.responses(cut(asked.select("*", models))).drop("prompt"))


def catalogue(paras: DataFrame, norms: DataFrame, source, config: Config) -> DataFrame:
    """(doc_id, col_idx, the stationary fields): the columns that each document describes, as
    the models agree. ``norms`` has the documents' normalised texts."""
    texts = segment.column_paragraphs(paras, 1 << 30)
    texts = texts.select("doc_id", F.substring(T.sanitized(F.col("text")), 1, config.catalogue_chars).alias("evidence")).where("evidence <> ''")
    answered = answers(texts.withColumn("prompt", prompts.catalogue(F.col("evidence"))), source, config)
    found = cut(response.columns(answered)).join(norms, "doc_id")
    checked = cut(validate.validated(found, normal="__norm").drop("__norm", "evidence"))
    checked = checked.where(F.coalesce(*STATIONARY).isNotNull()).withColumn("model_idx", config.model_place()).withColumnRenamed("item_seq", "ord")
    parts = [T.norm_key(F.col(c)) for c in ("manufacturer", "column_dimensions", "phase", "material")]
    name = T.norm_key(F.col("column_name"))
    key = F.when(name != "", F.concat(F.lit("name:"), name)).otherwise(F.concat_ws("|", *parts))
    kept = consensus.column_consensus(checked, config.least_models, key, STATIONARY)
    return kept.select("doc_id", (F.row_number().over(W.partitionBy("doc_id").orderBy("place")) - 1).alias("col_idx"), *STATIONARY)


def questions(paras: DataFrame, columns: DataFrame, config: Config) -> DataFrame:
    """(doc_id, pass, prompt_seq, evidence, snippet, prompt) of the passes over columns, over
    the paragraphs that say most, and over chunks."""
    v = config.vocabulary
    own = evidence.column_evidence(paras, columns, v).join(paras, ["doc_id", "para_idx"])
    told = evidence.evidence_text(own, evidence.technical_paragraphs(paras, v), v, max(2000, config.max_chars)).where("evidence <> ''")
    told = told.join(columns, ["doc_id", "col_idx"]).select("doc_id", F.lit(COLUMN).alias("pass"), F.col("col_idx").alias("prompt_seq"), "evidence", F.col("evidence").alias("snippet"), prompts.one_column(F.struct(*STATIONARY), F.col("evidence")).alias("prompt"))
    chunks = segment.chunks(paras, v, config.max_chars).join(prompts.catalogue_block(columns), "doc_id", "left")
    asked = told.unionByName(chunks.select("doc_id", F.lit(CHUNK).alias("pass"), F.col("chunk_id").alias("prompt_seq"), F.col("llm_text").alias("evidence"), F.col("raw_text").alias("snippet"), prompts.conditions(F.col("llm_text"), F.col("block")).alias("prompt")))
    if config.high_accuracy:
        whole = evidence.global_evidence(paras, v, config.global_chars).where("evidence <> ''")
        asked = asked.unionByName(whole.select("doc_id", F.lit(WHOLE).alias("pass"), F.lit(0).alias("prompt_seq"), "evidence", F.col("evidence").alias("snippet"), prompts.whole(F.col("evidence")).alias("prompt")))
    return asked


def sound(found: DataFrame, columns: DataFrame) -> DataFrame:
    """Records (doc_id, ord, col_idx, fields, __norm) held against their normalised text, then
    filled from the column they were asked for and from the document's catalogue."""
    # a plan in one piece would repeat the parts of a check in every check, and all in a filter
    checked = cut(validate.validated(cut(found), normal="__norm").drop("__norm"))
    return records.has_data(validate.with_catalog(validate.with_hint(checked, columns), columns))


def extraction(answered: DataFrame, norms: DataFrame, columns: DataFrame, config: Config) -> DataFrame:
    """Conditions of all passes, checked against their text, agreed between models, merged."""
    order = F.struct("pass", "prompt_seq", config.model_place().alias("m"), "item_seq")
    found = response.flat(response.records(answered)).withColumn("ord", order)
    texts = F.when(F.col("pass") == CHUNK, F.col("__norm")).otherwise(T.normalize(F.col("evidence")))
    found = found.join(norms, "doc_id").withColumn("__norm", texts).withColumn("col_idx", F.when(F.col("pass") == COLUMN, F.col("prompt_seq")))
    rows = sound(found, columns).select("doc_id", "ord", "pass", "model", *records.FIELDS, F.substring(T.normalize(F.col("snippet")), 1, 1200).alias("context_snippet"))
    rows = cut(rows)
    first = consensus.agreed(rows.where(F.col("pass") == COLUMN), config.least_models)
    agreed = consensus.agreed(first.unionByName(rows.where(F.col("pass") != COLUMN)), config.least_models)
    merged = consensus.null_tolerant_merge(agreed.drop("pass"), consensus.KEY)
    return merged.select("doc_id", F.col("kept_idx").alias("ord"), *records.FIELDS, "context_snippet")


def refined(conditions: DataFrame, paras: DataFrame, columns: DataFrame, source, config: Config) -> DataFrame:
    """The first conditions that lack values are asked about once more, and the first sound
    record of the answer counts. With ``compat`` it replaces the record, else it fills its
    nulls."""
    open_ = records.needs_refinement(conditions, config.refine_limit)
    tokens = open_.withColumn("tokens", evidence.condition_tokens(F.array(*[F.col(f) for f in records.FIELDS])))
    found = evidence.condition_evidence(tokens.select("doc_id", "ord", "tokens"), paras, config.vocabulary, max(2000, config.max_chars)).where("evidence <> ''")
    asked = found.join(open_.select("doc_id", "ord", *records.FIELDS), ["doc_id", "ord"]).select("doc_id", "ord", "evidence", prompts.refine(F.col("evidence")).alias("prompt"))
    answer = response.flat(response.records(answers(asked, source, config))).withColumn("__norm", T.normalize(F.col("evidence")))
    hints = validate.by_name(open_.select("doc_id", "ord", "column_name"), columns)
    answer = answer.join(hints, ["doc_id", "ord"], "left").withColumn("ord", F.struct("ord", config.model_place().alias("m"), "item_seq"))
    best = F.row_number().over(W.partitionBy("doc_id", "ord.ord").orderBy("ord.m", "ord.item_seq"))
    answer = sound(answer, columns).withColumn("r", best).where("r = 1")
    # one struct: of fields under new names the optimizer infers a filter for every choice of old and new
    answer = answer.select("doc_id", F.col("ord.ord").alias("ord"), F.struct(*records.FIELDS).alias("__new"))
    rows = conditions.join(answer, ["doc_id", "ord"], "left")
    pick = lambda f: F.when(F.col("__new").isNotNull(), F.col("__new")[f]).otherwise(F.col(f)) if config.compat else F.coalesce(f, F.col("__new")[f])
    return rows.withColumns({f: pick(f) for f in records.FIELDS}).select(*conditions.columns)


def cleaned(table: DataFrame, source, config: Config) -> tuple[DataFrame, DataFrame]:
    """The table as a model tidies it, and (doc_id, used, reason, row_count): tables of no or
    more than ``clean_rows`` rows, and those without a usable answer, stay as they are. The
    answer of the first model that gives a list counts and is not checked again."""
    rows = F.sort_array(F.collect_list(F.struct("ord", F.struct(*report.COLUMNS).alias("row"))))
    whole = table.groupBy("doc_id").agg(F.count("*").alias("row_count"), rows.alias("rows"))
    small = whole.where(F.col("row_count") <= config.clean_rows)
    asked = small.select("doc_id", F.lit("").alias("evidence"), prompts.clean(F.to_json(F.transform("rows", lambda x: x["row"]))).alias("prompt"))
    told = response.lists(answers(asked, source, config), ("conditions",), whole=False).withColumn("m", config.model_place())
    first = told.where("items IS NOT NULL").withColumn("r", F.row_number().over(W.partitionBy("doc_id").orderBy("m"))).where("r = 1")
    first = cut(first.select("doc_id", "model", "items"))
    new = first.select("doc_id", F.posexplode("items").alias("ord", "item"))
    leaf = lambda c: F.coalesce(F.try_variant_get("item", f"$.{c}", "string"), F.lit("")).alias(c)
    new = new.select("doc_id", "ord", *[leaf(c) for c in report.COLUMNS])
    out = table.join(first.select("doc_id"), "doc_id", "left_anti").unionByName(new)
    notes = whole.join(first.select("doc_id", "model", F.size("items").alias("n")), "doc_id", "left")
    reason = F.when(F.col("row_count") > config.clean_rows, "row_limit").when(F.col("n").isNull(), "no_output")
    return out, notes.select("doc_id", F.col("n").isNotNull().alias("used"), reason.alias("reason"), "model", F.coalesce(F.col("n").cast("bigint"), "row_count").alias("row_count"))


def statistics(answered: DataFrame, columns: DataFrame, conditions: DataFrame) -> DataFrame:
    """(doc_id, chunks, llm_calls, parse_failures, columns_catalog, conditions) of documents
    that were asked about."""
    failed = response.lists(answered, response.LIST_KEYS)
    asked = failed.groupBy("doc_id").agg(F.count_distinct(F.when(F.col("pass") != WHOLE, F.struct("pass", "prompt_seq"))).alias("chunks"), F.count("*").alias("llm_calls"), F.count_if(F.col("items").isNull()).alias("parse_failures"))
    count = lambda df, name: df.groupBy("doc_id").agg(F.count("*").alias(name))
    out = asked.join(count(columns, "columns_catalog"), "doc_id", "left").join(count(conditions, "conditions"), "doc_id", "left")
    return out.fillna(0, ["columns_catalog", "conditions"])


def run(docs: DataFrame, source, config: Config | None = None, known: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables by name: conditions, conditions_table, names, main_names, catalogue, statistics,
    counters, problems (records without the structure of one), and with config.clean conditions_raw and clean_up. ``docs`` is (doc_id, text);
    ``known`` has names that count as valid beside those of the abbreviations."""
    config = config or Config()
    table = abbreviations(docs.sparkSession)
    tagger = recognizer.train(docs, table) if config.recognize else None
    count = Counts()  # with the run's own jobs
    counts = cut(count.seen(mentions.mention_counts(mentions.mentions(docs, table, tagger.names if tagger else None)), "total_names_found"))
    names = table.select("name") if known is None else table.select("name").union(known.select("name"))
    valid = mentions.validated(counts, names) if config.validate_names else counts
    main = cut(count.seen(mentions.main_names(count.seen(valid, "validated_names"), config.threshold), "main_names"))
    paras = cut(count.seen(segment.paragraphs(docs), "total_paragraphs"))
    norms = cut(docs.select("doc_id", T.normalize(F.col("text")).alias("__norm")))  # once per document, not per field
    columns = cut(catalogue(paras, norms, source, config))
    answered = answers(questions(paras, columns, config), source, config)
    conditions = cut(extraction(answered, norms, columns, config))
    if config.high_accuracy and config.refine:
        conditions = refined(conditions, paras, columns, source, config)
    # what refining made alike is merged once more
    merged = consensus.null_tolerant_merge(cut(conditions), consensus.KEY)
    conditions = cut(merged.drop("ord").withColumnRenamed("kept_idx", "ord").select(*conditions.columns))
    linked = cut(link.linked(conditions, config.compat).drop("kept_idx"))
    kept = cut(count.seen(report.graded(report.with_patch(report.without_size_exclusion(linked), docs)), "conditions_found"))
    shown = report.compact(kept) if config.compact else kept
    groups = main.groupBy("doc_id").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct((-F.col("count")).alias("c"), "first", "name"))), lambda x: x["name"]), ", ").alias("__groups"))
    rows = report.table_rows(shown.join(groups, "doc_id", "left"), F.col("__groups"))
    out = {
        "conditions": records.nested(shown),
        "conditions_table": report.conditions_table(rows),
        "names": report.names_table(counts),
        "main_names": main,
        "catalogue": columns,
        "statistics": statistics(answered, columns, conditions),
        "counters": count.table(docs.sparkSession),
        "problems": records.problems(records.nested(shown).select("doc_id", "ord", F.to_json(F.struct(*records.GROUPS), {"ignoreNullFields": "false"}).alias("record"))),
    }
    if config.clean:
        out["conditions_raw"] = out["conditions_table"]
        out["conditions_table"], out["clean_up"] = cleaned(cut(out["conditions_raw"]), source, config)
    return out


def online_names(docs: DataFrame, service, cache: DataFrame | None = None, ledger: str | None = None) -> DataFrame:
    """(name) of the documents' names that a service knows, each distinct one asked for once;
    those of the abbreviations and of ``cache`` aren't asked for, nor those that ``ledger`` (a
    path that stays) has an answer to."""
    table = abbreviations(docs.sparkSession)
    sure = table.select("name") if cache is None else table.select("name").union(cache.select("name"))
    return cut(services.looked_up(mentions.mentions(docs, table), sure, service, ledger)).where("valid").select("name")


def result(docs: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """(doc_id, metadata, conditions, tables): one row per document, as files.save_json writes
    it. Lists keep the order of their tables."""
    listed = lambda df, columns, order, name: df.groupBy("doc_id").agg(F.transform(F.sort_array(F.collect_list(F.struct(*order, F.struct(*columns).alias("__r")))), lambda x: x["__r"]).alias(name))
    own = [*records.TOP, *records.GROUPS]
    extra = [c for c in ("completeness", "context_snippets") if c in tables["conditions"].columns]
    conditions = listed(tables["conditions"], [*own, *extra], ["ord"], "conditions")
    shown = listed(tables["conditions_table"], list(report.COLUMNS), ["ord"], "rows")
    main = listed(tables["main_names"], ["name", "count"], [(-F.col("count")).alias("c"), "first"], "main_names")
    out = docs.select("doc_id").distinct()
    for part in (conditions, shown, main, tables["statistics"].withColumnRenamed("conditions", "extracted")):
        out = out.join(part, "doc_id", "left")
    metadata = F.struct(F.coalesce(F.size("conditions"), F.lit(0)).alias("extracted_conditions"), F.transform("main_names", lambda x: x["name"]).alias("main_names_list"), F.struct("chunks", "llm_calls", "parse_failures", "columns_catalog", F.col("extracted").alias("conditions")).alias("extraction"))
    return out.select("doc_id", metadata.alias("metadata"), "conditions", F.struct(F.col("rows").alias("conditions")).alias("tables"))
