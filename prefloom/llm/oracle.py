"""SQL that computes the same rows in DuckDB, where SQL can express the operator."""

from __future__ import annotations

OP5 = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS digest
  FROM documents),
named AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * CAST(sum(size) AS BIGINT) AS cap,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn
  FROM sized GROUP BY source),
rates AS (
  SELECT *, turn + 1 AS weight, CASE turn WHEN 0 THEN -0.5::DOUBLE WHEN 1 THEN 0 ELSE 0.5 END AS slope,
    CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / (turn + 1), source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
    / CAST(sum(turn + 1) OVER (ORDER BY cap::DOUBLE / (turn + 1), source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS rate
  FROM named),
shares AS (
  SELECT source, source_size, slope, least(CAST(cap AS DOUBLE), CAST(weight AS DOUBLE) * max(rate) OVER ()) AS target
  FROM rates),
placed AS (
  SELECT z.doc_id, z.size, s.source_size, s.target, s.slope,
    CAST(coalesce(sum(z.size) OVER (PARTITION BY z.source ORDER BY z.digest, z.doc_id NULLS FIRST, z.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM sized z JOIN shares s ON z.source IS NOT DISTINCT FROM s.source),
taking AS (
  SELECT *, CAST(
      least(greatest(CAST(floor(target) AS BIGINT) - start, 0), size)
    + least(greatest(CAST(floor(target) AS BIGINT) - source_size - start, 0), size)
    + least(greatest(CAST(floor(target) AS BIGINT) - 2 * source_size - start, 0), size) AS BIGINT) AS taken,
    CASE WHEN start = 0 THEN 0.0::DOUBLE ELSE start::DOUBLE / target END AS done
  FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, taken,
  CASE WHEN taken > 0 THEN CASE WHEN start = 0 THEN 0 ELSE CAST(floor(
    2 * done / (1 - slope + sqrt((1 - slope) * (1 - slope) + 4 * slope * done)) * 1000000) AS BIGINT) END END AS position
FROM taking
"""

# every window of 35 words is a text; a word goes if a text that comes twice covers it
OP1 = """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i + 1 : i + 35], ' ') AS t
  FROM (SELECT r, w, unnest(range(len(w) - 34)) AS i FROM d WHERE len(w) >= 35) x),
twice AS (SELECT t FROM windows GROUP BY t HAVING count(*) > 1),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 35)) AS p FROM windows JOIN twice USING (t)),
words AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
kept AS (
  SELECT r, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (r, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

# all pairs of texts that share a shingle, and everything that links reach
OP2 = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
texts AS (SELECT row_number() OVER (ORDER BY w) AS s, w, count(*) AS copies, min(doc_id) AS least FROM w GROUP BY w),
sh AS (
  SELECT s, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' ')) END)) AS g FROM texts),
n AS (SELECT s, count(*) AS n FROM sh GROUP BY s),
shared AS (SELECT a.s AS a, b.s AS b, count(*) AS c FROM sh a JOIN sh b ON a.g = b.g AND a.s <> b.s GROUP BY 1, 2),
link AS (SELECT a, b FROM shared JOIN n x ON x.s = a JOIN n y ON y.s = b WHERE c >= 0.8 * (x.n + y.n - c) - 1e-9),
reach AS (SELECT s AS a, s AS b FROM n UNION SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
class AS (SELECT a AS s, min(least) AS class_id FROM reach JOIN texts ON texts.s = b GROUP BY 1),
links AS (SELECT a AS s, sum(copies) AS more FROM link JOIN texts ON texts.s = b GROUP BY 1)
SELECT w.doc_id, coalesce(class_id, w.doc_id) AS class_id,
  CAST(CASE WHEN class_id IS NULL THEN 0 ELSE coalesce(more, 0) + copies - 1 END AS BIGINT) AS n_links
FROM w JOIN texts USING (w) LEFT JOIN class USING (s) LEFT JOIN links USING (s)
"""

# pairs of lines that share one of their rarest tokens, as many as the threshold asks for
OP6 = """
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents),
l AS (
  SELECT doc_id, i AS line, list_distinct(list_filter(regexp_split_to_array(s, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')) AS t
  FROM (SELECT doc_id, unnest(ls) AS s, unnest(range(len(ls))) AS i FROM d) x),
k AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS LAST, line) AS p, len(t) AS n FROM l WHERE len(t) > 0),
one AS (SELECT p, n, unnest(t) AS w FROM k),
f AS (SELECT w, count(*) AS f FROM one GROUP BY w),
head AS (
  SELECT p, n, w FROM (SELECT p, n, w, row_number() OVER (PARTITION BY p ORDER BY f, w) AS place FROM one JOIN f USING (w)) x
  WHERE place <= n - ceil(0.8 * n - 1e-9) + 1),
pairs AS (
  SELECT DISTINCT a.p AS a, b.p AS b FROM head a JOIN head b ON a.w = b.w AND a.p < b.p
  WHERE least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
compared AS (
  SELECT b, x.n + y.n AS n, len(list_intersect(x.t, y.t)) AS c FROM pairs JOIN k x ON x.p = a JOIN k y ON y.p = b),
gone AS (SELECT DISTINCT b AS p FROM compared WHERE c >= 0.8 * (n - c) - 1e-9),
per_doc AS (
  SELECT doc_id, count(*) AS n, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS removed FROM gone JOIN k USING (p) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(removed, '') AS removed
FROM d LEFT JOIN per_doc USING (doc_id)
"""

OP11 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS t
  FROM documents),
cuts AS (
  SELECT doc_id, text, t, CAST(len(t) AS BIGINT) AS n,
    CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(t) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(t) + 1) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
      OR CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
      WHEN CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM d),
parts AS (
  SELECT *, array_to_string(t[1 : least(a, b)], '') AS p, array_to_string(t[least(a, b) + 1 : greatest(a, b)], '') AS m,
    array_to_string(t[greatest(a, b) + 1 : n], '') AS s
  FROM cuts)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
one AS (
  SELECT r, lang, source, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT r, lang, source, unnest(t) AS w FROM d) x),
kept AS (SELECT lang, term FROM one GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
terms AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
own AS (SELECT lang, source, term, count(*) AS n FROM one JOIN kept USING (lang, term) GROUP BY lang, source, term),
every AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN own o USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n,
    1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + 2 * v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (sum(n) OVER (PARTITION BY lang, term) + 2)::HUGEINT) // (sum(n) OVER (PARTITION BY lang) + 2 * v)::HUGEINT AS q
  FROM every JOIN terms USING (lang)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM rows)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""

ORACLE: dict[str, str] = {
    "op1_remove_repeats": OP1,
    "op2_join_near": OP2,
    "op5_mix_sources": OP5,
    "op6_remove_lines": OP6,
    "op11_fill_middle": OP11,
    "op12_audit_sources": OP12,
}
