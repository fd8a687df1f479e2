"""One query per operator over whole driver tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from godown.llm.arc_warc import op4_arc_to_warc
from godown.llm.bfd_pack import op1_bfd_pack
from godown.llm.byte_bpe import op6_byte_bpe
from godown.llm.filter_audit import op11_filter_audit
from godown.llm.gnat_codes import op13_gnat_codes
from godown.llm.int8_neardup import op7_int8_neardup
from godown.llm.lang_fusion import op3_language_fusion
from godown.llm.license_scan import op12_license_scan
from godown.llm.mcd_quality import op2_mcd_quality
from godown.llm.ngram_jaccard import op5_ngram_jaccard
from godown.llm.ordered_pack import op9_ordered_pack
from godown.llm.quote_links import op8_quote_links
from godown.llm.token_counts import op10_token_counts

QUERIES = {f.__name__: f for f in (
    op1_bfd_pack, op2_mcd_quality, op3_language_fusion, op4_arc_to_warc, op5_ngram_jaccard, op6_byte_bpe, op7_int8_neardup,
    op8_quote_links, op9_ordered_pack, op10_token_counts, op11_filter_audit, op12_license_scan, op13_gnat_codes)}

_SPACE = "\\x20\\x09-\\x0D"



def _codebook_rounds(rounds: int = 4) -> str:
    """Rounds of training the product codes, every part against every entry."""
    step = """,
a{n} AS MATERIALIZED (
  SELECT p.r, p.part, any_value(p.v) AS v, min({{'d': (p.vv - 2 * list_dot_product(p.v, c.v) + list_dot_product(c.v, c.v))::BIGINT, 'e': c.e}}) AS m
  FROM p JOIN c{n} c ON c.part = p.part GROUP BY p.r, p.part)"""
    new = """,
c{m} AS MATERIALIZED (
  SELECT c.part, c.e, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN (
    SELECT part, e, list(floor(s / n) ORDER BY i) AS v FROM (
      SELECT part, m.e AS e, i, sum(v[i]) AS s, count(*) AS n FROM a{n}, unnest(range(1, len(v) + 1)) AS t(i) GROUP BY ALL)
    GROUP BY part, e) m ON m.part = c.part AND m.e = c.e)"""
    return "".join(step.format(n=n) + (new.format(n=n, m=n + 1) if n < rounds else "") for n in range(rounds + 1))


ORACLE_SQL: dict[str, str] = {
    # Digests by their definition: 160 bits, five at a time, in the letters of base 32.
    "op4_arc_to_warc": """
WITH bits AS (
  SELECT page_id, encode(coalesce(html, '')) AS body,
         array_to_string(list_transform(range(1, 41), lambda i: lpad(bin(instr('0123456789abcdef', substr(sha1(encode(coalesce(html, ''))), i, 1)) - 1), 4, '0')), '') AS b
  FROM pages),
coded AS (
  SELECT page_id, octet_length(body) AS payload_bytes,
         array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 +
           16 * substr(b, 5 * k + 1, 1)::INTEGER + 8 * substr(b, 5 * k + 2, 1)::INTEGER + 4 * substr(b, 5 * k + 3, 1)::INTEGER
           + 2 * substr(b, 5 * k + 4, 1)::INTEGER + substr(b, 5 * k + 5, 1)::INTEGER, 1)), '') AS payload_digest
  FROM bits)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       nullif(max(page_id) OVER same, page_id) AS refers_to, true AS digests_match
FROM coded WINDOW same AS (PARTITION BY payload_digest)""",
    # All pairs of documents that share a shingle, and all that each reaches.
    "op5_ngram_jaccard": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^{_SPACE}]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id
  JOIN n nx ON nx.doc_id = x.doc_id JOIN n ny ON ny.doc_id = y.doc_id
  GROUP BY ALL HAVING 100 * count(*) >= 75 * (any_value(nx.n) + any_value(ny.n) - count(*))),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.other FROM reach r JOIN links l ON l.a = r.doc_id)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.other) AS component_id
FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id""",
    # Every pair of vectors.
    "op7_int8_neardup": """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x, v y WHERE x.vec_id <> y.vec_id AND list_dot_product(x.e, y.e)
    >= 0.95 * sqrt(list_dot_product(x.e, x.e) * list_dot_product(y.e, y.e))),
reach(vec_id, other) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.other FROM reach r JOIN links l ON l.a = r.vec_id)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id)::BIGINT AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reach GROUP BY vec_id""",
    # Every document through every order.
    "op11_filter_audit": f"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^{_SPACE}]+') AS w FROM documents),
f AS (
  SELECT t.doc_id, part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w), 100 * length(regexp_replace(x, '[^A-Z]', '', 'g')) > 10 * length(x),
    regexp_matches(x, '[#$%&*|]'), t.doc_id > min(t.doc_id) OVER (PARTITION BY x)] AS fails, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic
  FROM t LEFT JOIN (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id) l ON l.doc_id = t.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.c, b.c, c.c, d.c, e.c])) = 5),
gone AS (
  SELECT f.*, o, list_position(list_transform(range(1, 6), lambda s: fails[ascii(substr(o, s, 1)) - 64]), true) AS goes FROM f, orders),
counted AS (
  SELECT part, o AS filter_order, s::INTEGER AS step, substr(o, s, 1) AS c, count(*) FILTER (WHERE coalesce(goes, 6) > s) AS kept,
    count(*) FILTER (WHERE goes = s) AS removed, count(*) FILTER (WHERE fails[ascii(substr(o, s, 1)) - 64] AND goes < s) AS redundant,
    count(*) FILTER (WHERE fails[ascii(substr(o, s, 1)) - 64] AND len(list_filter(fails, lambda y: y)) = 1) AS unique_fails,
    count(*) FILTER (WHERE goes = s AND good) AS good_lost, count(*) FILTER (WHERE goes = s AND toxic) AS toxic_lost
  FROM gone, range(1, 6) AS steps(s) GROUP BY part, o, s)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, c))::BIGINT AS shapley FROM counted""",
    # Every part against every entry, in every round.
    "op13_gnat_codes": f"""
WITH k AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (
  SELECT r, vec_id, i AS part, q[i * len(q) // 4 + 1:(i + 1) * len(q) // 4] AS v, list_dot_product(v, v) AS vv FROM k, range(4) AS t(i)),
c0 AS MATERIALIZED (
  SELECT part, e, v FROM (SELECT part, v, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS e FROM p) WHERE e < 256)
{_codebook_rounds()},
coded AS (SELECT r, string_agg(format('{{:02x}}', m.e), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a4 GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: x::BIGINT), ','), ',' ORDER BY part, e)) AS h FROM c4)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM coded JOIN k USING (r), book""",
}
