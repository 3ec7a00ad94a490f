"""The opN_ queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.llm import common, conversations, grammar_files, hamerly, hamming_topk, jaccard_join, packing, pii, quality, secrets, sentencepiece_lattice, token_counts, toxicity, warc

BYTE_BPE, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.page_records(warc.read(spark, path, keep_payload=False))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op4_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return hamming_topk.top_k(rows, hamming_topk.sign_code(F.col("embedding")), F.col("vec_id") % 100 == 0, k=10)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = sentencepiece_lattice.Model.load(public_tokenizers.path(PIECES))
    return sentencepiece_lattice.digests(table(spark, sf_dir, "documents"), model)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return pii.find(docs, pii.train(pii.labelled_examples() + pii.corpus_examples(pii.corpus_texts(docs))))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = secrets.versions(table(spark, sf_dir, "documents"))
    ledger, _ = common.stored(spark, secrets.scan(history), "ledger")
    return secrets.digest(secrets.findings(history, ledger))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), public_tokenizers.PATTERN)


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair(table(spark, sf_dir, "conversations"))


def op12_grammar_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(spark, "token-ids")
    grammar_files.write(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), path)
    return grammar_files.read(spark, path)


def op13_hamerly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamerly.clusters(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_packing": op2_packing,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_hamming_topk": op4_hamming_topk,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_pii": op6_pii,
    "op7_secrets": op7_secrets,
    "op8_toxicity": op8_toxicity,
    "op9_quality": op9_quality,
    "op10_token_counts": op10_token_counts,
    "op11_conversations": op11_conversations,
    "op12_grammar_files": op12_grammar_files,
    "op13_hamerly": op13_hamerly,
}



def _kmeans_sql(k: int, rounds: int) -> str:
    """Vectors, k first centroids, a table of distances and one of means for each round."""
    near = "SELECT v.row, arg_min(c.cluster, (d, c.cluster)) AS cluster, min(d) AS distance FROM (SELECT v.row, c.cluster, list_sum(list_transform(range(1, 65), lambda i: (v.v[i] - c.v[i]) * (v.v[i] - c.v[i]))) AS d FROM v, c{n} c) c JOIN v ON v.row = c.row GROUP BY v.row"
    tables = [
        """i AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS x FROM embeddings WHERE len(embedding) = 64),
v AS (SELECT row, vec_id, list_transform(x, lambda a: CAST(floor(256 * a) AS BIGINT)) AS v FROM i WHERE len(list_filter(x, lambda a: a IS NULL OR isnan(a) OR isinf(a))) = 0)""",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), 'null')), v) - 1 AS cluster, v FROM v QUALIFY cluster < {k})",
    ]
    for n in range(rounds + 1):
        tables.append(f"n{n} AS MATERIALIZED ({near.format(n=n)})")
        if n < rounds:
            means = f"SELECT cluster, list(m ORDER BY i) AS v FROM (SELECT cluster, i, CAST(floor(sum(x) / count(*)) AS BIGINT) AS m FROM (SELECT n.cluster, unnest(range(1, 65)) AS i, unnest(v.v) AS x FROM n{n} n JOIN v ON v.row = n.row) GROUP BY ALL) GROUP BY cluster"
            tables.append(f"c{n + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN ({means}) m ON m.cluster = c.cluster)")
    return (
        f"WITH {', '.join(tables)} SELECT vec_id, CAST(n.cluster AS INTEGER) AS cluster, CAST(distance AS BIGINT) AS distance, CAST(sum(distance) OVER (PARTITION BY n.cluster) AS BIGINT) AS cluster_inertia, "
        f"CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256 FROM n{rounds} n JOIN v ON v.row = n.row JOIN c{rounds} c ON c.cluster = n.cluster"
    )


ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
b AS (SELECT page_id, payload, list_transform(range(1, 41), lambda i: instr('0123456789abcdef', substr(sha1(payload), CAST(i AS BIGINT), 1)) - 1) AS nibbles FROM p),
n AS (SELECT page_id, payload, list_transform(range(0, 160), lambda i: (nibbles[CAST(i // 4 + 1 AS BIGINT)] >> CAST(3 - i % 4 AS BIGINT)) & 1) AS bits FROM b),
d AS (SELECT page_id, payload, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  CAST(1 + 16 * bits[5 * i + 1] + 8 * bits[5 * i + 2] + 4 * bits[5 * i + 3] + 2 * bits[5 * i + 4] + bits[5 * i + 5] AS BIGINT), 1)), '') AS payload_digest,
  min(page_id) OVER (PARTITION BY payload) AS first FROM n)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM d""",
    "op3_jaccard_join": r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
  ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[CAST(i AS BIGINT) : CAST(i + 4 AS BIGINT)], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = d.doc_id) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id""",
    "op4_hamming_topk": """
WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CASE WHEN x > 0 THEN 1 ELSE 0 END) AS bits FROM embeddings WHERE len(embedding) > 0),
d AS (SELECT q.vec_id AS query_id, r.vec_id AS neighbor_id, CAST(list_sum(list_transform(range(1, len(q.bits) + 1), lambda i: abs(q.bits[CAST(i AS BIGINT)] - r.bits[CAST(i AS BIGINT)]))) AS INTEGER) AS distance
  FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 100 = 0),
o AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank, neighbor_id, distance FROM d)
SELECT query_id, rank, neighbor_id, distance FROM o WHERE rank <= 10""",
    "op11_conversations": r"""
WITH RECURSIVE c AS (SELECT list_transform(range(0, 256), lambda n: list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t),
h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  xor(list_reduce(list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)),
    lambda a, b: xor(a >> 8, t[CAST((xor(a, b) & 255) + 1 AS BIGINT)]), 4294967295), 4294967295) % 20 AS pick FROM conversations, c),
d AS (SELECT conv_id, turn, CASE WHEN pick = 4 THEN 'user' ELSE role END AS role, CASE WHEN pick = 1 THEN '' WHEN pick = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(CASE WHEN pick = 3 THEN [0, 1] ELSE [0] END) AS copy FROM h WHERE pick <> 0),
o AS (SELECT *, left(role, 1) AS initial, row_number() OVER w AS pos, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
  rtrim(text, E' 	

') AS kept, lag(left(role, 1)) OVER w AS before FROM d WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy)),
f AS (SELECT *, CASE WHEN kept = '' THEN 'blank' WHEN again THEN 'duplicate' WHEN right(kept, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM o),
n AS (SELECT i.conv_id, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
  count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal, count(pos) AS rows
  FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM i.conv_id GROUP BY i.conv_id),
-- per state (start, system, user, assistant) the cheapest rest as six digits of cost and its edits
p(conv_id, pos, s, y, u, a) AS (
  SELECT conv_id, rows + 1, '000000', '000006II', '000003I', '000000' FROM n
  UNION ALL
  SELECT conv_id, pos, least(os, printf('%06d', 3 + CAST(left(nu, 6) AS INTEGER)) || 'I' || substr(nu, 7)), least(oy, printf('%06d', 3 + CAST(left(nu, 6) AS INTEGER)) || 'I' || substr(nu, 7)), nu, na FROM (
    SELECT *, least(ou, printf('%06d', 3 + CAST(left(oa, 6) AS INTEGER)) || 'I' || substr(oa, 7)) AS nu, least(oa, printf('%06d', 3 + CAST(left(ou, 6) AS INTEGER)) || 'I' || substr(ou, 7)) AS na FROM (
      SELECT conv_id, pos,
        least(del_s, CASE WHEN NOT gone AND initial = 'u' THEN printf('%06d', more + cu) || 'K' || wu END, CASE WHEN NOT gone AND initial = 's' THEN printf('%06d', more + cy) || 'K' || wy END, CASE WHEN NOT gone AND initial <> 'u' THEN printf('%06d', more + 3 + cu) || 'R' || wu END) AS os,
        least(del_y, CASE WHEN NOT gone AND initial = 'u' THEN printf('%06d', more + cu) || 'K' || wu END, CASE WHEN NOT gone AND initial <> 'u' THEN printf('%06d', more + 3 + cu) || 'R' || wu END) AS oy,
        least(del_u, CASE WHEN NOT gone AND initial = 'a' THEN printf('%06d', more + ca) || 'K' || wa END, CASE WHEN NOT gone AND initial <> 'a' THEN printf('%06d', more + 3 + ca) || 'R' || wa END) AS ou,
        least(del_a, CASE WHEN NOT gone AND initial = 'u' THEN printf('%06d', more + cu) || 'K' || wu END, CASE WHEN NOT gone AND initial <> 'u' THEN printf('%06d', more + 3 + cu) || 'R' || wu END) AS oa
      FROM (SELECT p.conv_id, f.pos, f.initial, f.fault IN ('blank', 'duplicate') AS gone, CASE WHEN f.fault = 'truncated' THEN 3 ELSE 0 END AS more,
        CAST(left(y, 6) AS INTEGER) AS cy, CAST(left(u, 6) AS INTEGER) AS cu, CAST(left(a, 6) AS INTEGER) AS ca, substr(y, 7) AS wy, substr(u, 7) AS wu, substr(a, 7) AS wa,
        printf('%06d', 4 + CAST(left(s, 6) AS INTEGER)) || 'D' || substr(s, 7) AS del_s, printf('%06d', 4 + CAST(left(y, 6) AS INTEGER)) || 'D' || substr(y, 7) AS del_y,
        printf('%06d', 4 + CAST(left(u, 6) AS INTEGER)) || 'D' || substr(u, 7) AS del_u, printf('%06d', 4 + CAST(left(a, 6) AS INTEGER)) || 'D' || substr(a, 7) AS del_a
        FROM p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.pos = p.pos - 1)))),
z AS (SELECT conv_id, CAST(left(s, 6) AS BIGINT) AS cost, substr(s, 7) AS audit FROM p WHERE pos = 1),
e AS (SELECT conv_id, unnest(range(1, length(audit) + 1)) AS step, unnest(string_split(audit, '')) AS edit FROM z WHERE audit <> ''),
x AS (SELECT *, count(*) FILTER (edit <> 'I') OVER w AS pos, count(*) FILTER (edit <> 'D') OVER w AS place FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY step)),
k AS (SELECT x.*, f.role, f.text, f.initial FROM x LEFT JOIN f ON x.edit <> 'I' AND f.conv_id IS NOT DISTINCT FROM x.conv_id AND f.pos = x.pos WHERE x.edit <> 'D'),
q AS (SELECT *, place - (max(CASE WHEN place = 1 AND edit = 'K' AND initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id)) AS turn_no FROM k),
r AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN turn_no % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY step) AS repaired FROM q GROUP BY conv_id)
SELECT n.conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, sha256(coalesce(repaired, '')) AS repaired_sha256
FROM n JOIN z ON z.conv_id IS NOT DISTINCT FROM n.conv_id LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM n.conv_id""",
    "op13_hamerly": _kmeans_sql(40, 5),
}
