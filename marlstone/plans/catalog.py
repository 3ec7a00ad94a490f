"""Registered queries over the driver's tables, and the SQL that gives the same rows.

The document corpus has none of the domain's words, so queries over it take a vocabulary of
words that it has; record operators run on derived condition rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.functions import text as T
from marlstone.functions.lexicon import Vocabulary
from marlstone.operators import consensus, evidence, mentions, records, report, response, rules, segment, validate
from marlstone.plans.derived import CONDITIONS, conditions, table
from marlstone.sources import files

# Words of the corpus in the places of the domain's.
TERMS = (("THE", "the"), ("CI", "ci"), ("OF", "of"), ("DE", "de"), ("TO", "to"), ("AND", "and"), ("LA", "la"), ("IN", "in"), ("DER", "der"))
KNOWN = ("the", "of", "de")
WORDS = Vocabulary(relevant=("thing ", "heit ", "que la"), solvents=("with", "und", "pour"), critical=("license", "tion the"), technical=("password", "token"), sections=("this work",), column="for")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE_SQL[function.__name__] = sql
        return function

    return register


def _terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TERMS, "abbrev string, name string")


VALUES = ", ".join(f"('{a}', '{b}')" for a, b in TERMS)

# ---- documents

# DuckDB has no lookaround: boundaries become a mark that string_split cuts at
PARAS = r"""
t AS (SELECT doc_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '\[\d+\]', '', 'g'), '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g') AS x FROM documents),
m AS (SELECT doc_id, regexp_replace(regexp_replace(x, '\n\s*\n', chr(1), 'g'), '([.!?])\s*\n+([A-Z])', '\1' || chr(1) || '\2', 'g') AS x FROM t),
s AS (SELECT doc_id, unnest(list_filter(list_transform(string_split(x, chr(1)), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: length(p) > 20)) AS para,
  generate_subscripts(list_filter(list_transform(string_split(x, chr(1)), lambda p: regexp_replace(p, '^\s+|\s+$', '', 'g')), lambda p: length(p) > 20), 1) - 1 AS i FROM m),
paras AS (SELECT doc_id, CAST(i AS INTEGER) AS para_idx, para FROM s)"""


@query(f"WITH {PARAS} SELECT doc_id, para_idx, para FROM paras")
def paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.paragraphs(table(spark, sf_dir, "documents"))


COUNTS = rf"""
l(abbrev, name) AS (VALUES {VALUES}),
k AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z0-9_]+')) AS tok FROM documents),
counts AS (SELECT doc_id, name, count(*) AS count FROM k JOIN l ON tok = abbrev GROUP BY doc_id, name)"""


def _counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.term_counts(table(spark, sf_dir, "documents"), _terms(spark), r"[A-Za-z0-9_]+", 0)


@query(f"WITH {COUNTS} SELECT * FROM counts")
def mention_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


@query(f"WITH {COUNTS} SELECT doc_id, name, count FROM (SELECT *, max(count) OVER (PARTITION BY doc_id) AS top FROM counts) WHERE count >= 0.5 * top")
def main_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.main_names(_counts(spark, sf_dir))


@query(f"WITH {COUNTS} SELECT doc_id, name, count FROM (SELECT *, name IN {KNOWN} AS ok, bool_or(name IN {KNOWN}) OVER (PARTITION BY doc_id) AS found FROM counts) WHERE ok OR NOT found")
def validated_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mentions.validated(_counts(spark, sf_dir), spark.createDataFrame([(k,) for k in KNOWN], "name string"))


@query(f"WITH {COUNTS} SELECT name, CAST(sum(count) AS BIGINT) AS count FROM counts GROUP BY name")
def names_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.names_table(_counts(spark, sf_dir))


@query(
    r"""
WITH p AS (SELECT doc_id, unnest(regexp_extract_all(lower(coalesce(text, '')), 'tion[a-z\-]+')) AS name FROM documents)
SELECT doc_id, name, count(*) AS count FROM (SELECT doc_id, CASE WHEN name LIKE '%s' AND name NOT LIKE '%ss' THEN left(name, length(name) - 1) ELSE name END AS name FROM p) GROUP BY doc_id, name"""
)
def prefixed_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = docs.select("doc_id", F.explode(F.regexp_extract_all(F.lower(F.coalesce("text", F.lit(""))), F.lit(r"tion[a-z\-]+"), F.lit(0))).alias("name"))
    return found.select("doc_id", T.canonical_name(F.col("name")).alias("name")).groupBy("doc_id", "name").agg(F.count("*").alias("count"))


def sql_any(column: str, terms: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, '{t}')" for t in terms) + ")"


# steps of the normaliser that matter on ASCII-folded text
FOLD = r"trim(regexp_replace(regexp_replace(translate({c}, '–—−μµÅÅ×°º', '---uuAAx'), '[^\x00-\x7F]+', ' ', 'g'), '\s+', ' ', 'g'))"
SCORED = f"""
n AS (SELECT doc_id, para_idx, para, lower({FOLD.format(c="para")}) AS t FROM paras),
scored AS (SELECT doc_id, para_idx, para, CAST(
  CASE WHEN {sql_any("t", WORDS.sections)} THEN 1 ELSE 0 END + CASE WHEN {sql_any("t", WORDS.critical)} THEN 3 ELSE 0 END
  + CASE WHEN {sql_any("t", WORDS.solvents)} THEN 2 ELSE 0 END + CASE WHEN contains(t, '{WORDS.column}') THEN 2 ELSE 0 END AS INTEGER) AS score FROM n)"""


@query(f"WITH {PARAS}, {SCORED} SELECT doc_id, para_idx, score FROM scored")
def paragraph_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    paras = segment.paragraphs(table(spark, sf_dir, "documents")).withColumn("t", F.explode(F.array(F.lower(T.normalize(F.col("para"))))))
    t = F.col("t")  # worked out once, as an exploded element
    words = F.when(segment.has_any(t, WORDS.sections), 1).otherwise(0) + F.when(segment.has_any(t, WORDS.critical), 3).otherwise(0)
    words = words + F.when(segment.has_any(t, WORDS.solvents), 2).otherwise(0) + F.when(F.contains(t, F.lit(WORDS.column)), 2).otherwise(0)
    return paras.select("doc_id", "para_idx", words.alias("score"))


HIT = sql_any("lower(para)", WORDS.relevant)


@query(
    f"""
WITH {PARAS},
h AS (SELECT doc_id, para_idx, {HIT} AS hit, max(para_idx) OVER (PARTITION BY doc_id) AS last, bool_or({HIT}) OVER (PARTITION BY doc_id) AS found FROM paras),
a AS (SELECT doc_id, para_idx, greatest(para_idx - 2, 0) AS s, least(para_idx + 2, last) AS e FROM h WHERE hit OR NOT found),
f AS (SELECT *, max(e) OVER (PARTITION BY doc_id ORDER BY para_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM a),
w AS (SELECT *, sum(CASE WHEN far IS NULL OR s > far + 1 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY para_idx) - 1 AS win FROM f)
SELECT doc_id, CAST(win AS BIGINT) AS "window", min(s) AS start, max(e) AS "end" FROM w GROUP BY doc_id, win"""
)
def relevance_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.windows(segment.paragraphs(table(spark, sf_dir, "documents")), WORDS)


@query(
    f"""
WITH {PARAS}, h AS (SELECT doc_id, para_idx, para, regexp_matches(lower(para), 'thing|heit') AS hit, contains(lower(para), 'que') AS named FROM paras),
k AS (SELECT *, lag(hit, 1, false) OVER (PARTITION BY doc_id ORDER BY para_idx) AS before, bool_or(hit) OVER (PARTITION BY doc_id) AS found FROM h)
SELECT doc_id, left(string_agg(para, chr(10) || chr(10) ORDER BY para_idx), 5000) AS text FROM k WHERE hit OR before OR (NOT found AND named) GROUP BY doc_id"""
)
def column_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.column_paragraphs(segment.paragraphs(table(spark, sf_dir, "documents")), pattern="thing|heit", term="que")


COLUMN_NAMES = (("thing", None), ("heit", None), ("that", "which"))


@query(
    f"""
WITH {PARAS},
c(col_idx, col) AS (VALUES (0, 'thing'), (1, 'heit'), (2, 'that')),
n AS (SELECT doc_id, para_idx, lower({FOLD.format(c="para")}) AS t FROM paras),
p AS (SELECT n.doc_id, col_idx, para_idx, {sql_any("t", WORDS.solvents)} AS sol, {sql_any("t", WORDS.critical)} AS crit,
  (contains(t, col) OR (col = 'that' AND contains(t, 'which'))) AS by_all, contains(t, col) AS by_own FROM n, c
  WHERE NOT (col <> 'thing' AND contains(t, 'thing')) AND NOT (col <> 'heit' AND contains(t, 'heit')) AND NOT (col <> 'that' AND contains(t, 'that'))),
h AS (SELECT *, by_all AND sol AS hit, bool_or(by_all AND sol) OVER (PARTITION BY doc_id, col_idx) AS found FROM p)
SELECT doc_id, CAST(col_idx AS INTEGER) AS col_idx, para_idx FROM h WHERE hit OR (NOT found AND by_own AND (sol OR crit))"""
)
def column_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    columns = docs.select("doc_id").distinct().select("doc_id", F.posexplode(F.array(*[F.struct(F.lit(a).alias("column_name"), F.lit(b).cast("string").alias("modification")) for a, b in COLUMN_NAMES])).alias("col_idx", "c")).select("doc_id", "col_idx", "c.*")
    return evidence.column_evidence(segment.paragraphs(docs), columns, WORDS)


@query(f"SELECT doc_id, {FOLD.format(c='coalesce(text, chr(32))')} AS folded FROM documents")
def fold_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    glyphs = F.translate(F.coalesce("text", F.lit("")), "".join(T.GLYPHS) + T.DROPPED_GLYPHS, "".join(T.GLYPHS.values()))
    return table(spark, sf_dir, "documents").select("doc_id", F.trim(F.regexp_replace(F.regexp_replace(glyphs, r"[^\x00-\x7F]+", " "), r"\s+", " ")).alias("folded"))


# ---- pages and events


@query(
    r"""
SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''), '(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages"""
)
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", files.page_text(F.col("html")).alias("text"))


@query(
    r"""
WITH l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS links FROM pages)
SELECT page_id, CAST(unnest(range(0, len(links))) AS INTEGER) AS link_idx, unnest(links) AS link FROM l"""
)
def page_links_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    links = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    return table(spark, sf_dir, "pages").select("page_id", F.posexplode(links).alias("link_idx", "link"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE json_valid(props) AND json_extract_string(props, '$.k') IS NOT NULL")
def parse_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    answers = events.select("event_id", F.concat(F.lit('Here it is: {"conditions": ['), "props", F.lit("]} done")).alias("response"))
    return response.records(answers).select("event_id", F.get_json_object("record", "$.k").cast("bigint").alias("k")).where("k IS NOT NULL")


# ---- derived conditions

BASE = f"c AS ({CONDITIONS})"


@query(f"WITH {BASE} SELECT doc_id, ord, CASE WHEN regexp_matches(temperature, '[0-9]\\s*-\\s*[0-9]') THEN NULL ELSE regexp_extract(temperature, '([0-9]+(?:\\.[0-9]+)?)', 1) END AS temperature FROM c")
def temperature_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conditions(spark, sf_dir).select("doc_id", "ord", T.single_temperature(F.col("temperature")).alias("temperature"))


@query(
    f"""
WITH {BASE} SELECT doc_id, ord, TRY_CAST(ratio AS DOUBLE) AS lo, TRY_CAST(ratio AS DOUBLE) AS hi FROM c WHERE TRY_CAST(ratio AS DOUBLE) IS NOT NULL"""
)
def ratio_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conditions(spark, sf_dir).select("doc_id", "ord", T.ratio_range(F.col("ratio")).alias("r")).where("r IS NOT NULL").select("doc_id", "ord", "r.lo", "r.hi")


# numbers that end in 8 before a unit lose it (a misread degree sign)
DEGREE = r"regexp_replace(temperature, '\b([0-9]+)8 C', '\1 C', 'g')"


@query(
    rf"""
WITH {BASE}, v AS (SELECT doc_id, ord, {DEGREE} AS t FROM c), n AS (SELECT doc_id, ord, t, list_transform(regexp_extract_all(t, '[0-9]+'), lambda x: CAST(x AS DOUBLE)) AS n FROM v)
SELECT doc_id, ord, list_min(n) AS lo, list_max(n) AS hi, 'C' AS unit FROM n"""
)
def value_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conditions(spark, sf_dir).select("doc_id", "ord", T.value_range(F.col("temperature")).alias("r")).select("doc_id", "ord", "r.*")


SOLVENT_SQL = "CASE WHEN solvent IS NULL THEN NULL WHEN contains(solvent, 'butanone') THEN 'Butanone / Cyclohexane' ELSE 'Acetone / Water' END"


@query(f"WITH {BASE} SELECT doc_id, ord, {SOLVENT_SQL} AS solvent FROM c")
def solvent_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conditions(spark, sf_dir).select("doc_id", "ord", rules.solvent(F.col("solvent")).alias("solvent"))


@query(
    f"""
WITH {BASE}, s AS (SELECT doc_id, ord, ratio, {SOLVENT_SQL} AS solvent, TRY_CAST(ratio AS INTEGER) AS v FROM c)
SELECT doc_id, ord, CASE WHEN solvent IS NOT NULL AND v BETWEEN 1 AND 99 THEN CASE WHEN v < 50 THEN (100 - v) || '/' || v ELSE v || '/' || (100 - v) END ELSE ratio END AS ratio FROM s"""
)
def ratio_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conditions(spark, sf_dir).withColumn("solvent", rules.solvent(F.col("solvent")))
    return rows.select("doc_id", "ord", rules.both_shares(F.col("ratio"), F.col("solvent")).alias("ratio"))


@query(
    f"""
WITH {BASE}, n AS (SELECT doc_id, ord, lower(coalesce(column_name, '')) AS c, lower(coalesce(critical_polymer_unit, '')) AS m FROM c)
SELECT doc_id, ord, CASE WHEN contains(c, 'diol') OR contains(m, 'diol') THEN 'Normal phase' WHEN contains(c, 'dvb') OR contains(m, 'divinyl') THEN 'Reversed phase (polymeric)'
  WHEN contains(c, 'hs-peg') OR (contains(c, 'peg') AND contains(m, 'silica')) THEN 'Reversed phase (PEG-modified silica)' WHEN contains(c, 'rp') THEN 'Reversed phase' END AS phase FROM n"""
)
def phase_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    none = F.lit(None).cast("string")
    return conditions(spark, sf_dir).select("doc_id", "ord", rules.phase(none, F.col("column_name"), none, F.col("critical_polymer_unit")).alias("phase"))


@query(
    f"""
WITH {BASE}, p AS (SELECT doc_id, ord, CASE WHEN ord % 3 = 0 THEN (100 + ord) || ' A' WHEN ord % 3 = 1 THEN '10x' || ord ELSE column_name END AS n FROM c)
SELECT doc_id, ord, CASE WHEN ord % 3 = 2 THEN n END AS column_name, CASE WHEN ord % 3 = 0 THEN replace(n, ' ', '') || ' A' END AS pore_size FROM p"""
)
def column_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("ord") % 3 == 0, F.concat((F.col("ord") + 100).cast("string"), F.lit(" A"))).when(F.col("ord") % 3 == 1, F.concat(F.lit("10x"), F.col("ord").cast("string"))).otherwise(F.col("column_name"))
    rows = conditions(spark, sf_dir).select("doc_id", "ord", name.alias("n"))
    return rows.select("doc_id", "ord", rules.real_column(F.col("n")).alias("column_name"), rules.pore_of_phantom(F.lit(None).cast("string"), F.col("n")).alias("pore_size"))


KEYS = ("manufacturer",)


@query(
    f"""
WITH {BASE}, k AS (SELECT *, coalesce(lower(manufacturer), '') AS key FROM c),
n AS (SELECT doc_id, key FROM k GROUP BY doc_id, key HAVING count(DISTINCT model) >= 2)
SELECT k.doc_id, ord, model FROM k JOIN n ON n.doc_id = k.doc_id AND n.key = k.key"""
)
def consensus_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consensus.agreed(conditions(spark, sf_dir), 2, KEYS).select("doc_id", "ord", "model")


@query(
    f"""
WITH {BASE}, s AS (SELECT *, CASE WHEN ord % 4 = 0 THEN 'THF' ELSE {SOLVENT_SQL} END AS sol, CASE WHEN ord % 5 = 0 THEN 'used for sec only' WHEN ord % 7 = 0 THEN 'at the critical point' ELSE '' END AS purpose FROM c)
SELECT doc_id, ord FROM s WHERE NOT ((purpose = 'used for sec only') OR (coalesce(sol, '') = 'THF' AND ratio IS NULL AND purpose <> 'at the critical point'))"""
)
def sec_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conditions(spark, sf_dir)
    solvent = F.when(F.col("ord") % 4 == 0, "THF").otherwise(rules.solvent(F.col("solvent")))
    purpose = F.when(F.col("ord") % 5 == 0, "used for sec only").when(F.col("ord") % 7 == 0, "at the critical point").otherwise("")
    rows = rows.withColumn("solvent", solvent).withColumn("purpose", purpose).withColumn("critical_block_behavior", F.lit(None).cast("string")).withColumn("column_name", F.lit("x"))
    return report.without_size_exclusion(rows).select("doc_id", "ord")


@query(
    f"""
WITH {BASE}, g AS (SELECT doc_id, ord, (column_name IS NOT NULL OR manufacturer IS NOT NULL) AS a, (solvent IS NOT NULL OR ratio IS NOT NULL) AS b FROM c)
SELECT doc_id, ord, CASE WHEN a AND b THEN 'complete' ELSE 'partial' END AS completeness FROM g WHERE a OR b"""
)
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.graded(records.complete_columns(conditions(spark, sf_dir))).select("doc_id", "ord", "completeness")


CATALOG = """cat AS (SELECT DISTINCT l_orderkey AS doc_id, CAST(l_linenumber AS INTEGER) AS col_idx, p_brand AS column_name, 'm' || p_size AS material FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber <= 2),
first AS (SELECT doc_id, col_idx, min(column_name) AS column_name, min(material) AS material FROM cat GROUP BY doc_id, col_idx)"""


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    # lines 1 and 2 are the catalogue by the definition in CATALOG; conditions of further
    # lines are all there and may be without an entry, as in a document's catalogue
    rows = table(spark, sf_dir, "lineitem").where("l_linenumber <= 2").join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select(F.col("l_orderkey").alias("doc_id"), F.col("l_linenumber").alias("col_idx"), F.col("p_brand").alias("column_name"), F.concat(F.lit("m"), "p_size").alias("material"))
    return rows.groupBy("doc_id", "col_idx").agg(F.min("column_name").alias("column_name"), F.min("material").alias("material"))


MATCH = "contains(lower(m.manufacturer), lower(f.column_name)) OR contains(lower(f.column_name), lower(m.manufacturer))"


@query(f"WITH {BASE}, {CATALOG} SELECT m.doc_id, m.ord, min(f.col_idx) AS col_idx FROM c m JOIN first f ON f.doc_id = m.doc_id AND ({MATCH}) GROUP BY m.doc_id, m.ord")
def catalog_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conditions(spark, sf_dir).select("doc_id", "ord", F.col("manufacturer").alias("column_name"))
    return validate.by_name(rows, _catalog(spark, sf_dir))


@query(
    f"""
WITH {BASE}, {CATALOG}, b AS (SELECT m.doc_id, m.ord, min(f.col_idx) AS col_idx FROM c m JOIN first f ON f.doc_id = m.doc_id AND ({MATCH}) GROUP BY m.doc_id, m.ord)
SELECT c.doc_id, c.ord, c.manufacturer AS column_name, f.material FROM c LEFT JOIN b ON b.doc_id = c.doc_id AND b.ord = c.ord LEFT JOIN first f ON f.doc_id = b.doc_id AND f.col_idx = b.col_idx
WHERE b.doc_id IS NOT NULL OR c.doc_id NOT IN (SELECT doc_id FROM first)"""
)
def catalog_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conditions(spark, sf_dir).select("doc_id", "ord", F.col("manufacturer").alias("column_name"), F.lit(None).cast("string").alias("material"))
    return validate.with_catalog(rows, _catalog(spark, sf_dir), ("column_name",), ("material",))


@query(
    f"""
WITH {BASE}, v AS (SELECT doc_id, ord, manufacturer AS value, coalesce(column_name, '') || ' at ' || coalesce(manufacturer, 'none') || ' 60:40 ' || coalesce(ratio, '') AS source, ratio FROM c)
SELECT doc_id, ord, coalesce(value <> '' AND contains(lower(source), lower(value)), false) AS in_text, CASE WHEN ratio IS NOT NULL THEN ratio END AS ratio FROM v"""
)
def field_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = F.concat(F.coalesce("column_name", F.lit("")), F.lit(" at "), F.coalesce("manufacturer", F.lit("none")), F.lit(" 60:40 "), F.coalesce("ratio", F.lit("")))
    rows = conditions(spark, sf_dir).withColumn("source", source)
    return rows.select("doc_id", "ord", T.value_in_text(F.col("manufacturer"), F.col("source")).alias("in_text"), validate.checked("ratio", F.col("ratio"), F.col("source")).alias("ratio"))


@query(f'WITH {BASE} SELECT \'ratio\' AS "column", least(greatest(coalesce(max(length(ratio)), 0), 5) + 2, 50) AS width FROM c UNION ALL SELECT \'column_name\', least(greatest(coalesce(max(length(column_name)), 0), 11) + 2, 50) FROM c')
def sheet_widths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.sheet_widths(conditions(spark, sf_dir), ("ratio", "column_name"))
