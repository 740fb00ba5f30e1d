"""Registered queries of the training-data operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ordertally.llm import (
    chat_format,
    chat_repair,
    collocations,
    decontaminate,
    html_text,
    near_dup,
    packing,
    pii,
    quality_rank,
    quality_rules,
    topk_search,
    toxicity,
    warc_archive,
)
from ordertally.llm.common import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _on(fn: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: fn(*[read_table(spark, sf_dir, t) for t in tables])


def queries() -> dict[str, Query]:
    return {
        "op1_html_text": _on(html_text.op1, "pages"),
        "op2_toxicity": _on(toxicity.op2, "documents", "labels"),
        "op3_order_minhash": _on(near_dup.op3, "documents"),
        "op4_retrieval_packing": _on(packing.op4, "documents"),
        "op5_personal_data": _on(pii.op5, "documents"),
        "op6_divergence_rules": _on(quality_rules.op6, "documents"),
        "op7_chat_windows": _on(chat_format.op7, "conversations"),
        "op8_warc_archive": _on(warc_archive.op8, "pages"),
        "op9_quality_rank": _on(quality_rank.op9, "documents", "labels"),
        "op10_decontaminate": _on(decontaminate.op10, "documents", "benchmark"),
        "op11_collocations": _on(collocations.op11, "documents"),
        "op12_topk_search": _on(topk_search.op12, "embeddings"),
        "op13_chat_repair": _on(chat_repair.op13, "conversations"),
    }


_WORDS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

# Archives: of equal payloads of 1000 bytes or more, the largest page id is kept.
_ARCHIVE_SQL = """
WITH payloads AS (SELECT page_id, encode(COALESCE(html, '')) AS body FROM pages),
sized AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS payload_digest FROM payloads),
kept AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN MAX(page_id) OVER (PARTITION BY payload_digest) END AS kept_id FROM sized)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN kept_id IS DISTINCT FROM page_id AND kept_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN kept_id IS DISTINCT FROM page_id THEN kept_id END AS refers_to
FROM kept"""

# Contamination: every window of every document against every window of every item.
_WINDOWS_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS row, doc_id, COALESCE({_WORDS}, []) AS words FROM documents),
item_words AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS words FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item, LEAST(len(words), 10) AS size,
    array_to_string(words[place + 1 : place + LEAST(len(words), 10)], ' ') AS shown
  FROM item_words, unnest(range(0, GREATEST(len(words) - 9, 1))) AS places(place) WHERE len(words) > 0),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT row, place, size, array_to_string(words[place + 1 : place + size], ' ') AS shown
  FROM docs CROSS JOIN sizes, unnest(range(0, len(words) - size + 1)) AS places(place)),
hits AS (SELECT DISTINCT row, item, place, w.size FROM doc_windows w JOIN item_windows i ON i.size = w.size AND i.shown = w.shown),
hit_words AS (
  SELECT row, COUNT(DISTINCT word) AS n_hit
  FROM (SELECT row, unnest(range(place, place + size)) AS word FROM hits) GROUP BY row),
found AS (SELECT row, COUNT(item) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row, item FROM hits) GROUP BY row)
SELECT doc_id, len(words) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items,
  sha256(COALESCE(items, '')) AS items_sha256, COALESCE(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (row) LEFT JOIN found USING (row)"""


# Collocations: every phrase of one to three words within a piece, per language.
_COLLOCATIONS_SQL = r"""
WITH pieces AS (
  SELECT COALESCE(lang, 'und') AS lang,
    unnest(string_split_regex(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, size, array_to_string(w[place : place + size - 1], ' ') AS phrase
  FROM words, (SELECT unnest([1, 2, 3]) AS size) AS sizes, unnest(range(1, len(w) - size + 2)) AS places(place)),
counted AS (SELECT lang, size, phrase, CAST(COUNT(*) AS HUGEINT) AS f FROM grams GROUP BY lang, size, phrase),
candidates AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.a, cut, l.f AS l, r.f AS r, 1000000 * c.a * c.a // (l.f * r.f) AS score
  FROM candidates c, unnest(range(1, size)) AS places(cut)
    JOIN counted l ON l.lang = c.lang AND l.size = cut AND l.phrase = array_to_string(c.w[1 : cut], ' ')
    JOIN counted r ON r.lang = c.lang AND r.size = c.size - cut AND r.phrase = array_to_string(c.w[cut + 1 :], ' ')),
lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS place FROM cuts) WHERE place = 1),
inside AS (
  SELECT lang, array_to_string(w[part : part + 1], ' ') AS phrase, MAX(a) AS longer
  FROM candidates, (SELECT unnest([1, 2]) AS part) AS parts WHERE size = 3 GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept),
totals AS (SELECT lang, SUM(f) AS n FROM counted WHERE size = 1 GROUP BY lang)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n,
  CAST(score AS BIGINT) AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""

# Search: every query against every other row.
_SEARCH_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5"""


def oracle_sql() -> dict[str, str]:
    """The other operators (models, sketches, parsers, token ids) have no SQL form."""
    return {
        "op8_warc_archive": _ARCHIVE_SQL,
        "op10_decontaminate": _WINDOWS_SQL,
        "op11_collocations": _COLLOCATIONS_SQL,
        "op12_topk_search": _SEARCH_SQL,
    }
