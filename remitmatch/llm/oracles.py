"""DuckDB statements for the operators that SQL can express, written from their contracts."""

from __future__ import annotations

from remitmatch.llm.licenses import LOWER, NOTICES, PHRASES, SEPARATORS, UPPER, templates


def _templates() -> str:
    return ", ".join(
        f"({template}, '{label}', {base}, {pairs}, {need}::BIGINT, {place}, '{a}', '{b}')"
        for template, label, base, pairs, need, place, a, b in templates(PHRASES, NOTICES))


LICENSES = f"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '{SEPARATORS}'), lambda x: x <> '') AS words FROM documents),
pair AS (
  SELECT doc_id, i - 1 AS spot, words[i] AS w1, words[i + 1] AS w2
  FROM (SELECT doc_id, words, unnest(range(1, len(words))) AS i FROM split)),
template(template, label, base, pairs, need, place, t1, t2) AS (VALUES {_templates()}),
diagonal AS (
  SELECT doc_id, template, label, base, pairs, need, spot - place AS diagonal, min(spot) AS low,
    bit_or(1::BIGINT << place) AS seen
  FROM pair JOIN template ON w1 = t1 AND w2 = t2 GROUP BY ALL),
stepped AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER line <= 2 THEN 0 ELSE 1 END AS step
  FROM diagonal WHERE NOT base WINDOW line AS (PARTITION BY doc_id, template ORDER BY diagonal)),
numbered AS (
  SELECT *, sum(step) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS run FROM stepped),
span AS (
  SELECT doc_id, label, base, diagonal AS first_word, 1.0::DOUBLE AS covered
  FROM diagonal WHERE base AND bit_count(seen) = pairs
  UNION ALL
  SELECT doc_id, label, false, min(low), (bit_count(bit_or(seen)) / pairs)::DOUBLE
  FROM numbered GROUP BY doc_id, template, label, pairs, need, run
  HAVING bit_count(bit_or(seen)) / pairs >= 0.6 AND bit_or(seen) & need = need)
SELECT s.doc_id, any_value(len(s.words))::BIGINT AS n_words,
  count(*) FILTER (WHERE base)::BIGINT AS n_base,
  min(first_word) FILTER (WHERE base)::BIGINT AS first_word,
  max(first_word) FILTER (WHERE base)::BIGINT AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base), '') AS base_labels,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
  coalesce(max(covered), 0)::DOUBLE AS score
FROM split s LEFT JOIN span USING (doc_id) GROUP BY s.doc_id
"""

EMBEDDINGS = """
WITH RECURSIVE vector AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM vector a JOIN vector b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach(x, root) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION SELECT y, root FROM reach JOIN link USING (x)),
component AS (SELECT x, min(root) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n FROM link GROUP BY x)
SELECT e.vec_id, coalesce(d.n, 0)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN component c ON c.x = e.vec_id LEFT JOIN degree d ON d.x = e.vec_id
"""

REPEATS = """
WITH body AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
byte AS (
  SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS w
  FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM body)),
earliest AS (SELECT w, min(doc_id) AS first FROM byte WHERE length(w) = 100 GROUP BY w),
marked AS (
  SELECT b.doc_id, b.i, substr(b.w, 1, 2) AS h, CASE WHEN e.first < b.doc_id THEN b.i END AS hit
  FROM byte b LEFT JOIN earliest e USING (w)),
covered AS (
  SELECT doc_id, i, h, coalesce(i - max(hit) OVER (PARTITION BY doc_id ORDER BY i) < 50, false) AS gone
  FROM marked),
edge AS (
  SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins
  FROM covered),
document AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS removed, count(*) FILTER (WHERE begins) AS spans,
    coalesce(string_agg(h, '' ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM edge GROUP BY doc_id)
SELECT b.doc_id, (length(b.h) // 2)::BIGINT AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
  coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM body b LEFT JOIN document USING (doc_id)
"""

SHINGLES = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i
        FROM split WHERE len(words) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM shingle a JOIN shingle b
  ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT x, y FROM common JOIN size p ON p.doc_id = x JOIN size q ON q.doc_id = y
  WHERE 100 * k >= 80 * (p.n + q.n - k)),
reach(x, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT y, root FROM reach JOIN link USING (x)),
component AS (SELECT x, min(root) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN component c ON c.x = d.doc_id LEFT JOIN size s ON s.doc_id = d.doc_id
"""

SEARCH = f"""
WITH split AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words FROM documents),
asked AS (
  SELECT item_id, unnest(list_filter(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')) AS term FROM benchmark),
total AS (SELECT count(*) AS docs, sum(len(words))::BIGINT AS words FROM split WHERE len(words) > 0),
occurs AS (
  SELECT doc_id, n, term, count(*) AS tf
  FROM (SELECT doc_id, len(words) AS n, unnest(words) AS term FROM split)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weight AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
  FROM occurs, total GROUP BY term),
part AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // words))) AS part
  FROM occurs JOIN weight USING (term), total),
scored AS (
  SELECT item_id, doc_id, sum(part)::BIGINT AS score FROM asked JOIN part USING (term) GROUP BY item_id, doc_id)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank
  FROM scored WHERE score > 0) WHERE rank <= 20
"""

ORACLE = {
    "op1_diagonal_license_scan": LICENSES,
    "op5_product_quantisation": EMBEDDINGS,
    "op7_deep_shallow_suffixes": REPEATS,
    "op10_circulant_minhash": SHINGLES,
    "op12_reversed_search": SEARCH,
}
