"""The queries of this package as SQL, where SQL can express them."""

from __future__ import annotations

OP3 = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, source_size * 3.0::DOUBLE AS cap,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM totals
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0.0))
            / sum(weight) OVER rest AS level
  FROM weighed
  WINDOW before AS (ORDER BY cap / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         rest AS (ORDER BY cap / weight, source NULLS LAST
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), targets AS (
  SELECT source, source_size, cap, weight,
         max(CASE WHEN level * weight <= cap THEN level END) OVER () AS final
  FROM levels
), rated AS (
  SELECT source, source_size, least(cap, coalesce(final * weight, cap)) AS target,
         CASE WHEN source_size > 0
              THEN least(least(cap, coalesce(final * weight, cap)) / source_size, 3.0)
              ELSE 0.0 END AS rate
  FROM targets
)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, r.source_size, r.target,
       CAST(s.size * (floor(r.rate) + CASE WHEN
         CAST(('0x' || substr(md5('17|' || coalesce(CAST(s.doc_id AS VARCHAR), '')), 1, 10)) AS BIGINT)
           / 1099511627776.0::DOUBLE < r.rate - floor(r.rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source
"""

OP6 = r"""
WITH ordered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), sided AS (
  SELECT CAST(floor(conv_id / 2) AS BIGINT) AS pair_id, conv_id % 2 = 0 AS good, role, text, pos FROM ordered
), sizes AS (
  SELECT pair_id, coalesce(max(pos) FILTER (good), 0) AS a, coalesce(max(pos) FILTER (NOT good), 0) AS b
  FROM sided GROUP BY pair_id
), differing AS (
  SELECT x.pair_id, min(x.pos) AS pos FROM sided x JOIN sided y
    ON x.pair_id = y.pair_id AND x.pos = y.pos AND x.good AND NOT y.good
  WHERE x.role <> y.role OR x.text <> y.text GROUP BY x.pair_id
), prefixes AS (
  SELECT s.pair_id, s.a > 0 AS has_a, s.b > 0 AS has_b, coalesce(d.pos - 1, least(s.a, s.b)) AS n
  FROM sizes s LEFT JOIN differing d USING (pair_id)
), rendered AS (
  SELECT t.pair_id, t.good, t.pos, t.pos <= p.n AS shared, t.role = 'assistant' AS assistant, length(t.text) + 10 AS size,
         '<|im_start|>' || t.role || chr(10) || t.text || '<|im_end|>' || chr(10) AS line
  FROM sided t JOIN prefixes p USING (pair_id)
)
SELECT p.pair_id, CAST(p.n AS BIGINT) AS prompt_turns,
       md5(coalesce(string_agg(line, '' ORDER BY pos) FILTER (good AND shared), '')) AS prompt_md5,
       CASE WHEN any_value(has_a) THEN md5(coalesce(string_agg(line, '' ORDER BY pos) FILTER (good AND NOT shared), '')) END AS chosen_md5,
       CASE WHEN any_value(has_b) THEN md5(coalesce(string_agg(line, '' ORDER BY pos) FILTER (NOT good AND NOT shared), '')) END AS rejected_md5,
       CASE WHEN any_value(has_a) THEN CAST(coalesce(sum(size) FILTER (good AND NOT shared AND assistant), 0) AS BIGINT) END AS chosen_trained,
       CASE WHEN any_value(has_b) THEN CAST(coalesce(sum(size) FILTER (NOT good AND NOT shared AND assistant), 0) AS BIGINT) END AS rejected_trained
FROM prefixes p JOIN rendered r USING (pair_id)
GROUP BY p.pair_id, p.n
"""

OP11 = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || CAST(doc_id AS VARCHAR)) AS hex,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units
  FROM documents
), drawn AS (
  SELECT *, CAST(len(units) AS BIGINT) AS n,
         CAST('0x' || substr(hex, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(hex, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(hex, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(hex, 25, 8) AS BIGINT) AS h4
  FROM hashed
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(units[1:a], ''), '') AS prefix,
         coalesce(array_to_string(units[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(units[b + 1:n], ''), '') AS suffix
  FROM cut
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def _round(k: int) -> str:
    """Assignment to the centroids c{k}, and the centroids c{k + 1} after it."""
    return f"""
, a{k} AS (
  SELECT v.vec_id, v.q, c.cluster,
         CAST(list_inner_product(v.q, v.q) + list_inner_product(c.q, c.q) - 2 * list_inner_product(v.q, c.q)
              AS BIGINT) AS distance
  FROM v CROSS JOIN c{k} c
  QUALIFY row_number() OVER (PARTITION BY v.vec_id ORDER BY distance, c.cluster) = 1
), s{k} AS (
  SELECT cluster, i, CAST(sum(x) AS BIGINT) AS total, count(*) AS n
  FROM (SELECT cluster, CAST(unnest(q) AS BIGINT) AS x, generate_subscripts(q, 1) AS i FROM a{k}) GROUP BY cluster, i
), m{k} AS (
  SELECT cluster, list(CAST((total - ((total % n) + n) % n) / n AS DOUBLE) ORDER BY i) AS q FROM s{k} GROUP BY cluster
), c{k + 1} AS (
  SELECT c.cluster, coalesce(m.q, c.q) AS q FROM c{k} c LEFT JOIN m{k} m USING (cluster)
)"""


OP12 = f"""
WITH v AS (
  SELECT vec_id, [floor(64 * CAST(x AS DOUBLE)) for x in embedding] AS q FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if isfinite(x)]) = 64
), c0 AS (
  SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR))) - 1 AS INTEGER) AS cluster, q
  FROM v QUALIFY cluster < 16
){_round(0)}{_round(1)}{_round(2)}{_round(3)}
SELECT a.vec_id, a.cluster, a.distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string([CAST(CAST(x AS BIGINT) AS VARCHAR) for x in c3.q], ',')) AS centroid_sha256
FROM a3 a JOIN c3 USING (cluster)
"""

OP13 = """
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lined AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM split
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lined
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS gone FROM keyed k LEFT JOIN common c USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

SQL = {
    "op3_mixing": OP3,
    "op6_chat_format": OP6,
    "op11_fill_in_middle": OP11,
    "op12_centroid_clusters": OP12,
    "op13_line_dedup": OP13,
}
