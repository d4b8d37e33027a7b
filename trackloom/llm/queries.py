"""The registered queries of this subpackage: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from trackloom.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.near_dedup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), n=4, percent=80)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.substring_dedup import digests, substring_dedup

    return digests(substring_dedup(table(spark, sf_dir, "documents")))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.toxicity import fit, score_documents

    docs = table(spark, sf_dir, "documents")
    return score_documents(docs, fit(docs, table(spark, sf_dir, "labels")))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.token_output import pack_matrices

    return pack_matrices(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.chat import examples, read_back, with_probe

    return read_back(examples(with_probe(table(spark, sf_dir, "conversations"))))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.secrets import report, scan

    return report(scan(table(spark, sf_dir, "documents")))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.html_text import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.decontamination import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.exact_dedup import exact_dedup

    return exact_dedup(table(spark, sf_dir, "documents"))


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.licenses import scan_licenses

    return scan_licenses(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.hard_negatives import hard_negatives

    return hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from trackloom.llm.clustering import cluster_vectors

    return cluster_vectors(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_near_dedup, op2_substring_dedup, op3_toxicity, op4_token_output, op5_packing, op6_chat_format, op7_secrets, op8_html_text, op9_decontamination, op10_exact_dedup, op11_licenses, op12_hard_negatives, op13_clusters)}


def oracle_sql() -> dict[str, str]:
    return {"op6_chat_format": OP6_SQL, "op10_exact_dedup": OP10_SQL, "op11_licenses": op11_sql(), "op12_hard_negatives": OP12_SQL, "op13_clusters": op13_sql()}


OP10_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       coalesce(doc_id = max(doc_id) OVER same, false) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP6_SQL = """
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), sized AS (
  SELECT *, 14 + length(role) + length(regexp_replace(role, '[^\\\\#<:]', '', 'g')) + length(text) + length(regexp_replace(text, '[^\\\\#<]', '', 'g')) AS chars FROM said
), placed AS (
  SELECT *, sum(chars) OVER turns AS upto, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) = 1 AS last
  FROM sized WINDOW turns AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR last) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""


def op11_sql() -> str:
    """Every phrase at every word, and every notice against every block: no order of words, no filters."""
    from trackloom.llm.licenses import BLOCK, NOTICES, PERCENT, PHRASES, STRIDE

    phrases = ", ".join(f"({k}, '{label}', [{', '.join(repr(w) for w in p.split())}])" for k, (p, label) in enumerate(PHRASES))
    notices = ", ".join(f"({k}, '{label}', '{text}')" for k, (label, text) in enumerate(NOTICES))
    return rf"""
WITH said AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words
  FROM documents
), word AS MATERIALIZED (
  SELECT doc_id, unnest(range(0, len(words))) AS i, unnest(words) AS token, words FROM said
), phrase(k, label, parts) AS (VALUES {phrases}),
base AS (
  SELECT doc_id, i, label FROM word JOIN phrase ON token = parts[1] AND list_slice(words, i + 1, i + len(parts)) = parts
), notice(notice, label, text) AS (VALUES {notices}),
held AS (SELECT DISTINCT notice, label, unnest(string_split(text, ' ')) AS token FROM notice),
sized AS (SELECT notice, count(*) AS n FROM held GROUP BY notice),
placed AS (
  SELECT doc_id, i // {STRIDE} - b AS block, token FROM word, (VALUES (0), (1)) AS back(b) WHERE i // {STRIDE} - b >= 0 AND token IN (SELECT token FROM held)
), met AS (
  SELECT doc_id, block, notice, label, count(DISTINCT token) AS shared, any_value(n) AS n
  FROM placed JOIN held USING (token) JOIN sized USING (notice) GROUP BY doc_id, block, notice, label
  HAVING count(DISTINCT token) * 100 >= any_value(n) * {PERCENT}
), by_base AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id
), by_label AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM met) AS u GROUP BY doc_id
), by_share AS (SELECT doc_id, max(CAST(shared AS DOUBLE) / n) AS share FROM met GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(share, 0.0)::DOUBLE END AS score
FROM said LEFT JOIN by_base USING (doc_id) LEFT JOIN by_label USING (doc_id) LEFT JOIN by_share USING (doc_id)
"""


OP12_SQL = """
WITH kept AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_inner_product(CAST(a.v AS DOUBLE[]), CAST(b.v AS DOUBLE[])) AS BIGINT) AS score
  FROM kept a JOIN kept b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) AS place FROM scored WHERE same
), negative AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS place
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
  WHERE p.place <= 5
)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negative WHERE place <= 3
"""


def op13_sql() -> str:
    """Ten rounds written out, each against all centroids. Vectors and centroids are in long form: a row for each component."""
    from trackloom.llm.clustering import CENTROIDS, ROUNDS

    steps = [
        f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), part AS MATERIALIZED (SELECT r, unnest(range(0, 64)) AS j, unnest(v) AS x FROM kept),
c0 AS MATERIALIZED (
  SELECT k, unnest(range(0, 64)) AS j, unnest(v) AS x
  FROM (SELECT v, row_number() OVER (ORDER BY sha256('3:' || CAST(vec_id AS VARCHAR)), v) - 1 AS k FROM kept) AS hashed WHERE k < {CENTROIDS}
)"""
    ]
    for t in range(ROUNDS + 1):
        steps.append(f"""far{t} AS MATERIALIZED (
  SELECT r, k, CAST(sum((p.x - c.x) * (p.x - c.x)) AS BIGINT) AS d FROM part p JOIN c{t} c ON p.j = c.j GROUP BY r, k
), a{t} AS MATERIALIZED (SELECT r, k, d FROM (SELECT r, k, d, row_number() OVER (PARTITION BY r ORDER BY d, k) AS place FROM far{t}) AS o WHERE place = 1)""")
        if t < ROUNDS:
            steps.append(f"""m{t} AS MATERIALIZED (
  SELECT k, j, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS x FROM part JOIN a{t} USING (r) GROUP BY k, j
), c{t + 1} AS MATERIALIZED (SELECT c.k, c.j, coalesce(m.x, c.x) AS x FROM c{t} c LEFT JOIN m{t} m ON c.k = m.k AND c.j = m.j)""")
    last = ROUNDS
    return "WITH " + ",\n".join(steps) + f""",
told AS (SELECT k, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c{last} GROUP BY k)
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
FROM a{last} JOIN kept USING (r) JOIN told USING (k)
"""
