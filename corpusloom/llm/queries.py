"""The queries of this folder's operators and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import functions as F

from .exact_dedup import exact_dedup
from .license_scan import scan_licenses
from .lm_scoring import corpus_scores
from .ngram_join import N, THRESHOLD, ngram_jaccard_join
from .packing import best_fit_packing
from .piece_coding import encode_pieces
from .quality_rules import RULES, STOP_WORDS, quality_verdicts
from .shared import table
from .token_output import encode_corpus
from .toxicity import toxicity_scores
from .warc import CHUNK_BYTES, warc_chunks


def _warc(spark, sf_dir):
    """Chunk rows with the payload in base64, so that the values compare alike in every client."""
    return warc_chunks(table(spark, sf_dir, "pages")).withColumn("payload", F.translate(F.base64("payload"), "\r\n", ""))


def queries() -> dict:
    return {
        "op1_toxicity": lambda s, d: toxicity_scores(table(s, d, "documents"), table(s, d, "labels")),
        "op2_best_fit_packing": lambda s, d: best_fit_packing(table(s, d, "documents")),
        "op3_warc_chunks": _warc,
        "op4_quality_rules": lambda s, d: quality_verdicts(table(s, d, "documents")),
        "op5_token_output": lambda s, d: encode_corpus(table(s, d, "documents"))[0],
        "op6_ngram_jaccard_join": lambda s, d: ngram_jaccard_join(table(s, d, "documents")),
        "op7_license_scan": lambda s, d: scan_licenses(table(s, d, "documents")),
        "op8_exact_dedup": lambda s, d: exact_dedup(table(s, d, "documents")),
        "op9_piece_coding": lambda s, d: encode_pieces(table(s, d, "documents")),
        "op10_lm_scoring": lambda s, d: corpus_scores(table(s, d, "documents"), table(s, d, "labels").where("quality = 1")),
    }


def _rules_sql() -> str:
    cases = "\n".join(
        f"      WHEN {metric} {comparison} {threshold}{f' AND n_words >= {least}' if least else ''} THEN '{name}'" for name, metric, comparison, threshold, least in RULES if threshold is not None
    )
    stops = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS.split())))
    ratio = lambda a, b: f"CASE WHEN {b} > 0 THEN round(CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE), 6) ELSE 0.0 END"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
p AS (SELECT doc_id, t, len(regexp_extract_all(t, '[^\\t\\n\\x0B\\f\\r ]+')) AS n_words,
        length(regexp_replace(t, '[\\t\\n\\x0B\\f\\r ]', '', 'g')) AS solid,
        length(t) - length(regexp_replace(t, '[#$%&*<>{{}}|~^=_@\\\\]', '', 'g')) AS symbols,
        len(regexp_extract_all(t, '!!')) AS shouts, len(regexp_extract_all(t, '\\p{{Lu}}')) AS capitals,
        len(list_filter(string_split_regex(lower(t), '[^\\p{{L}}]+'), lambda w: w IN ({stops}))) AS stops,
        list_filter(string_split(t, chr(10)), lambda x: length(regexp_replace(x, '[\\t\\r ]', '', 'g')) > 0) AS lines FROM t),
m AS (SELECT doc_id, n_words, {ratio('solid', 'n_words')} AS mean_word_length, {ratio('symbols', 'length(t)')} AS symbol_ratio,
        {ratio('shouts', 'n_words')} AS shout_ratio, {ratio('capitals', 'solid')} AS capital_ratio, {ratio('stops', 'n_words')} AS stop_word_ratio,
        {ratio("len(list_filter(lines, lambda x: regexp_matches(x, '^[\\t\\r ]*[-*•]')))", 'len(lines)')} AS bullet_line_ratio,
        {ratio("len(list_filter(lines, lambda x: suffix(x, '...') OR suffix(x, '…')))", 'len(lines)')} AS ellipsis_line_ratio,
        {ratio('(len(lines) - len(list_distinct(lines)))', 'len(lines)')} AS duplicate_line_ratio FROM p)
SELECT *, reason IS NULL AS keep FROM (SELECT *, CASE
{cases}
      ELSE NULL END AS reason FROM m)
"""


_JOIN_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[\\x00-\\x20]+'), lambda x: x <> '') AS w FROM documents WHERE text IS NOT NULL AND doc_id IS NOT NULL),
s AS (SELECT doc_id, list_sort(list_distinct(list_transform(range(greatest(len(w) - {N} + 1, 1)), lambda i: array_to_string(w[i + 1 : i + {N}], ' ')))) AS g FROM w WHERE len(w) > 0),
k AS MATERIALIZED (SELECT doc_id, g, min(doc_id) OVER (PARTITION BY g) AS head, count(*) OVER (PARTITION BY g) AS copies FROM s),
u AS (SELECT doc_id, copies, len(g) AS n, unnest(g) AS x FROM k WHERE doc_id = head),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, b.copies AS m, a.n AS nx, b.n AS ny, count(*) AS c FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT x, y, m FROM c WHERE c / (nx + ny - c) >= {THRESHOLD}),
r AS (SELECT DISTINCT x, x AS y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
l AS (SELECT x, min(y) AS class_id FROM r GROUP BY x), n AS (SELECT x, sum(m) AS n FROM e GROUP BY x)
SELECT d.doc_id, coalesce(l.class_id, k.head, d.doc_id) AS class_id, CAST(coalesce(n.n, 0) + coalesce(k.copies - 1, 0) AS BIGINT) AS n_links
FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL) d LEFT JOIN k ON k.doc_id = d.doc_id LEFT JOIN l ON l.x = k.head LEFT JOIN n ON n.x = k.head
"""


_WARC_SQL = f"""
WITH p AS (SELECT '<urn:page:' || coalesce(CAST(page_id AS VARCHAR), '') || '>' AS record_id, url, encode(coalesce(html, '')) AS b FROM pages),
c AS (SELECT *, octet_length(b) AS size, unnest(range(greatest((octet_length(b) + {CHUNK_BYTES - 1}) // {CHUNK_BYTES}, 1))) AS chunk_no FROM p)
SELECT record_id, url, chunk_no, chunk_no * {CHUNK_BYTES} AS byte_start, least({CHUNK_BYTES}, size - chunk_no * {CHUNK_BYTES}) AS n_bytes,
  base64(b[chunk_no * {CHUNK_BYTES} + 1 : (chunk_no + 1) * {CHUNK_BYTES}]) AS payload,
  sha256(b[1 : (chunk_no + 1) * {CHUNK_BYTES}]) AS digest, (chunk_no + 1) * {CHUNK_BYTES} >= size AS is_last FROM c
"""


def oracle_sql() -> dict:
    return {
        "op3_warc_chunks": _WARC_SQL,
        "op4_quality_rules": _rules_sql(),
        "op6_ngram_jaccard_join": _JOIN_SQL,
        "op8_exact_dedup": "SELECT min(doc_id) AS doc_id, md5(text) AS text_md5, count(*) AS n_copies FROM documents GROUP BY text",
    }
