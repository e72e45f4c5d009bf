"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACES = "(' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

OP9 = f"""
WITH lines AS (
  SELECT doc_id, rn, unnest(parts) AS body, generate_subscripts(parts, 1) AS line
  FROM (SELECT doc_id, row_number() OVER () AS rn, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, rn, body, line, {_LOWER.format(f"trim(body, {_SPACES})")} AS key FROM lines
), firsts AS (
  SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10 AND doc_id IS NOT NULL GROUP BY key
), judged AS (
  SELECT k.*, coalesce(k.doc_id > f.first_doc, false) AS lost FROM keyed k LEFT JOIN firsts f ON k.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(body, chr(10) ORDER BY line) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id, rn
"""

_BENCH_WORDS = r"regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP5 = f"""
WITH item_words AS (
  SELECT item_id, {_BENCH_WORDS} AS w FROM benchmark
), windows AS (
  SELECT item_id, n, p, list_slice(w, p, p + n - 1) AS win
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p
        FROM item_words WHERE len(w) > 0)
), doc_words AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce({_BENCH_WORDS}, []) AS w FROM documents
), places AS (
  SELECT d.rn, s.n, p, list_slice(d.w, p, p + s.n - 1) AS win
  FROM (SELECT rn, w, unnest(range(1, len(w) + 1)) AS p FROM doc_words) d, (SELECT DISTINCT n FROM windows) s
  WHERE p + s.n - 1 <= len(d.w) AND w[p] IN (SELECT win[1] FROM windows)
), matches AS (
  SELECT DISTINCT rn, places.p, places.n, item_id, places.p - windows.p AS shift
  FROM places JOIN windows ON places.win = windows.win
), hits AS (
  SELECT rn, count(DISTINCT spot) AS n_hit FROM (SELECT rn, unnest(range(p, p + n)) AS spot FROM matches) GROUP BY rn
), named AS (
  SELECT rn, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rn, CAST(item_id AS VARCHAR) AS item FROM matches WHERE item_id IS NOT NULL) GROUP BY rn
), runs AS (
  SELECT rn, item_id, min(p) - 1 AS longest_at, count(*) + min(n) - 1 AS longest_match
  FROM (SELECT *, p - row_number() OVER (PARTITION BY rn, item_id, shift ORDER BY p) AS run FROM matches)
  GROUP BY rn, item_id, shift, run
), longest AS (
  SELECT rn, longest_match, longest_at, CAST(item_id AS VARCHAR) AS longest_item FROM runs
  QUALIFY row_number() OVER (PARTITION BY rn ORDER BY longest_match DESC, longest_at, item_id) = 1
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated,
       coalesce(longest_match, 0) AS longest_match, longest_at, longest_item
FROM doc_words LEFT JOIN hits USING (rn) LEFT JOIN named USING (rn) LEFT JOIN longest USING (rn)
"""

OP4 = f"""
WITH RECURSIVE doc_words AS (
  SELECT row_number() OVER () AS rn, doc_id,
         coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents
), sets AS (
  SELECT rn, doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s
  FROM doc_words
), tokens AS (
  SELECT rn, len(s) AS n, unnest(s) AS t FROM sets WHERE doc_id IS NOT NULL
), ranked AS (
  SELECT rn, n, t, row_number() OVER (PARTITION BY rn ORDER BY df, t) AS place
  FROM tokens JOIN (SELECT t, count(*) AS df FROM tokens GROUP BY t) USING (t)
), prefixes AS (  -- two sets that are similar enough share one of their rarest tokens
  SELECT rn, n, t FROM ranked WHERE place <= n - (80 * n + 99) // 100 + 1
), candidates AS (
  SELECT DISTINCT x.rn AS a, y.rn AS b FROM prefixes x JOIN prefixes y ON x.t = y.t AND x.rn < y.rn
  WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)
), links AS (
  SELECT a, b FROM (
    SELECT a, b, len(list_intersect(x.s, y.s)) AS i, len(x.s) + len(y.s) AS total
    FROM candidates JOIN sets x ON x.rn = a JOIN sets y ON y.rn = b)
  WHERE 100 * i >= 80 * (total - i)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT rn AS a, rn AS b FROM sets WHERE rn IN (SELECT a FROM both_ways)
  UNION
  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
), smallest AS (
  SELECT reach.a AS rn, min(sets.doc_id) AS least_doc FROM reach JOIN sets ON reach.b = sets.rn GROUP BY reach.a
)
SELECT doc_id, len(s) AS n_shingles, coalesce(least_doc, doc_id) AS component_id,
       doc_id IS NOT DISTINCT FROM coalesce(least_doc, doc_id) AS kept
FROM sets LEFT JOIN smallest USING (rn)
"""

OP2 = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), named AS (
  SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS least FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN least IS NOT NULL AND page_id IS DISTINCT FROM least THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM least THEN least END AS refers_to
FROM named
"""

def _codes_sql(parts: int = 4, entries: int = 256, rounds: int = 4) -> str:
    """Every round compares all parts with all entries; the numbers of a part are rows (place, x)."""

    def nearest(books: str) -> str:
        return f"""
  SELECT vec, part, entry, distance FROM (
    SELECT n.vec, n.part, b.entry, sum((n.x - b.x) * (n.x - b.x))::BIGINT AS distance
    FROM numbers n JOIN {books} b ON n.part = b.part AND n.place = b.place GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY vec, part ORDER BY distance, entry) = 1"""

    steps = ""
    for k in range(1, rounds + 1):
        steps += f""", near{k} AS MATERIALIZED ({nearest(f"books{k - 1}")}
), books{k} AS MATERIALIZED (
  SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x FROM books{k - 1} b LEFT JOIN (
    SELECT part, entry, place, floor(sum(x) / count(*))::BIGINT AS x FROM near{k} JOIN numbers USING (vec, part) GROUP BY ALL
  ) m USING (part, entry, place)
)"""
    return f"""
WITH kept AS (
  SELECT vec_id, label, embedding, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS vec FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), numbers AS MATERIALIZED (
  SELECT vec, spot * {parts} // size AS part, spot - (spot * {parts} // size) * (size // {parts}) AS place, floor(1024 * x::DOUBLE)::BIGINT AS x
  FROM (SELECT vec, len(embedding) AS size, unnest(embedding) AS x, generate_subscripts(embedding, 1) - 1 AS spot FROM kept)
), books0 AS MATERIALIZED (
  SELECT part, vec AS entry, place, x FROM numbers WHERE vec < {entries}
){steps}, coded AS (
  SELECT vec, string_agg(lpad(lower(to_hex(entry)), 2, '0'), '' ORDER BY part) AS code, sum(distance)::BIGINT AS error
  FROM ({nearest(f"books{rounds}")}) GROUP BY vec
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM books{rounds}) AS codebooks_sha256
FROM kept JOIN coded USING (vec)
"""


OP12 = _codes_sql()

OP13 = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rn, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), firsts AS (
  SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text
), told AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT d.part, coalesce(t.good, 0) AS good, coalesce(t.toxic, 0) AS toxic, {
    'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
    'C': 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 3 * length(d.text),
    'D': regexp_matches(d.text, '[#$%&*|]'), 'E': coalesce(f.first_id < d.doc_id, false)} AS f
  FROM docs d JOIN firsts f ON d.text = f.text LEFT JOIN told t ON d.doc_id = t.doc_id
), letters AS (
  SELECT part, good, toxic, list_filter(['A', 'B', 'C', 'D', 'E'], lambda x: CASE x WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C
         WHEN 'D' THEN f.D ELSE f.E END) AS fails FROM failed
), combos AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM letters GROUP BY ALL
), orders AS (
  SELECT '' AS o UNION ALL SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x)
), steps AS (
  SELECT o AS filter_order, s::INT AS step, o[s] AS own, string_split(o[:s - 1], '') AS earlier
  FROM orders, (SELECT unnest(range(1, 6)) AS s) WHERE length(o) = 5
), judged AS (
  SELECT part, filter_order, step, n, good, toxic, list_contains(fails, own) AS fail, list_has_any(fails, earlier) AS gone,
         len(fails) AS k FROM combos, steps
)
SELECT part, filter_order, step, coalesce(sum(n) FILTER (NOT fail AND NOT gone), 0)::BIGINT AS kept,
       coalesce(sum(n) FILTER (fail AND NOT gone), 0)::BIGINT AS removed, coalesce(sum(n) FILTER (fail AND gone), 0)::BIGINT AS redundant,
       coalesce(sum(n) FILTER (fail AND k = 1), 0)::BIGINT AS unique_fails,
       coalesce(sum(good) FILTER (fail AND NOT gone), 0)::BIGINT AS good_lost,
       coalesce(sum(toxic) FILTER (fail AND NOT gone), 0)::BIGINT AS toxic_lost,
       coalesce(sum(120 * n // greatest(k, 1)) FILTER (fail), 0)::BIGINT AS shapley
FROM judged GROUP BY part, filter_order, step
"""

LLM_SQL: dict[str, str] = {
    "op2_warc_bundles": OP2, "op4_near_dedup": OP4, "op5_decontaminate": OP5, "op9_line_dedup": OP9,
    "op12_vector_codes": OP12, "op13_filter_audit": OP13,
}
