"""SQL for those queries of this subpackage that SQL can express, as DuckDB runs it."""

# Lower-cased words of a text.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

ORACLE_SQL = {
    "op2_decontamination": f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(13, len(w)) AS k FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT *, unnest(range(1, len(w) - k + 2)) AS i FROM sized)),
places AS (
  SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS g
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM docs, (SELECT DISTINCT k FROM windows))),
found AS (SELECT r, i, p.k, item FROM places p JOIN windows v ON p.g = v.g AND p.k = v.k),
hit AS (
  SELECT r, count(DISTINCT j) AS n
  FROM (SELECT r, unnest(range(i, i + k)) AS j FROM found) GROUP BY r),
hit_items AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(t.n, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(h.n, 0) > 0 AND 20 * coalesce(h.n, 0) >= len(w) AS contaminated
FROM docs d LEFT JOIN hit h ON d.r = h.r LEFT JOIN hit_items t ON d.r = t.r""",
    "op3_warc": """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages)
SELECT page_id, strlen(payload) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr(
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + list_sum(list_transform(range(5), lambda j:
           CAST(substr(bits, CAST(5 * k + j + 1 AS BIGINT), 1) AS BIGINT) * CAST(2 ** (4 - j) AS BIGINT)))::BIGINT,
         1)), '') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM (SELECT *, CAST(CAST(unhex(sha1(payload)) AS BIT) AS VARCHAR) AS bits FROM payloads)""",
    "op5_near_duplicates": f"""
WITH RECURSIVE docs AS (SELECT doc_id, array_to_string({_WORDS}, ' ') AS words, {_WORDS} AS w FROM documents),
nodes AS (SELECT words, min(doc_id) AS node, any_value(w) AS w FROM docs GROUP BY words),
sets AS (
  SELECT DISTINCT node, array_to_string(w[i:i + 4], ' ') AS shingle
  FROM (SELECT node, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM nodes WHERE len(w) > 0)),
sizes AS (SELECT node, count(*) AS n FROM sets GROUP BY node),
pairs AS (
  SELECT a.node AS a, b.node AS b, count(*) AS n
  FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.node <> b.node GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs p JOIN sizes x ON p.a = x.node JOIN sizes y ON p.b = y.node
  WHERE p.n >= 0.8 * (x.n + y.n - p.n)),
reach AS (
  SELECT node, node AS other FROM nodes
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a)
SELECT doc_id, class_id
FROM docs JOIN nodes USING (words)
JOIN (SELECT node, min(other) AS class_id FROM reach GROUP BY node) USING (node)""",
    # A CRC-32 is that of as many zero bytes, XORed with what each byte adds at its distance
    # from the end; the recursions build both tables.
    "op11_importance_resampling": f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
items AS (SELECT {_WORDS} AS w FROM benchmark),
runs AS (
  SELECT r, array_to_string(w[i:i + k], ' ') AS f
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 1)) AS i FROM docs, range(3) AS ks(k))),
item_runs AS (
  SELECT array_to_string(w[i:i + k], ' ') AS f
  FROM (SELECT w, k, unnest(range(1, len(w) - k + 1)) AS i FROM items, range(3) AS ks(k))),
different AS (SELECT f, encode(f) AS b FROM (SELECT f FROM runs UNION SELECT f FROM item_runs)),
bits(b, s, i) AS (
  SELECT range, CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL SELECT b, xor(s >> 1, CASE WHEN s & 1 = 1 THEN 3988292384 ELSE 0 END), i + 1 FROM bits WHERE i < 8),
base AS (SELECT list(s ORDER BY b) AS t FROM bits WHERE i = 8),
added(b, s, d) AS (
  SELECT b, s, 0 FROM bits WHERE i = 8
  UNION ALL SELECT a.b, xor(a.s >> 8, t[1 + (a.s & 255)]), a.d + 1 FROM added a, base
  WHERE a.d < (SELECT max(octet_length(b)) FROM different)),
zeros(n, s) AS (
  SELECT 0, CAST(4294967295 AS BIGINT)
  UNION ALL SELECT n + 1, xor(z.s >> 8, t[1 + (z.s & 255)]) FROM zeros z, base
  WHERE n < (SELECT max(octet_length(b)) FROM different)),
bytes AS (
  SELECT f, n, n - 1 - i AS d, CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT) AS b
  FROM (SELECT f, hex(b) AS h, octet_length(b) AS n, unnest(range(octet_length(b))) AS i FROM different)),
buckets AS (
  SELECT f, xor(xor(any_value(z.s), bit_xor(a.s)), 4294967295) % 10000 AS bucket
  FROM bytes y JOIN added a ON y.b = a.b AND y.d = a.d JOIN zeros z ON y.n = z.n GROUP BY f),
source AS (SELECT bucket, count(*) AS n FROM runs JOIN buckets USING (f) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS n FROM item_runs JOIN buckets USING (f) GROUP BY bucket),
totals AS (
  SELECT CAST((SELECT count(*) FROM runs) AS DOUBLE) AS s, CAST((SELECT count(*) FROM item_runs) AS DOUBLE) AS t),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.n, 0) + 1.0::DOUBLE) * (totals.s + 10000)
    / ((s.n + 1.0::DOUBLE) * (totals.t + 10000)))) AS BIGINT) AS gain
  FROM source s LEFT JOIN target t USING (bucket), totals),
weights AS (
  SELECT r, count(*) AS n, sum(gain) AS weight FROM runs JOIN buckets USING (f) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('42:' || doc_id), 1, 8) AS BIGINT)
           + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
  FROM docs LEFT JOIN weights USING (r)),
ranked AS (
  SELECT *, CASE WHEN words >= 20 THEN row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) END AS place,
         5 * count(*) FILTER (words >= 20) OVER () // 100 AS drawn
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM ranked""",
    "op13_fill_in_middle": """
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || doc_id) AS h
  FROM documents),
drawn AS (
  SELECT *, len(u) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS c1,
         CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 90 THEN 'plain'
              WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM docs),
parts AS (
  SELECT *, array_to_string(u[:least(c1, c2)], '') AS p,
         array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m,
         array_to_string(u[greatest(c1, c2) + 1:], '') AS s
  FROM drawn)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts""",
}
