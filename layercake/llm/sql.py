"""SQL for the queries that it can express, for another engine."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# CRC-32 (fixed polynomial) with the table built from its rule, byte by byte.
_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    list_prepend(n::BIGINT, range(8)),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(3988292384, c // 2) ELSE c // 2 END)) AS of
)"""
_CRC = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(
      range(1, 2 * octet_length(encode({0})), 2),
      lambda i: ('0x' || substr(hex(encode({0})), i, 2))::BIGINT)),
    lambda c, b: xor(crc_table.of[(xor(c, b) & 255) + 1], c >> 8)))"""

OP5 = f"""
WITH {_CRC_TABLE}, rows_ AS (
  SELECT doc_id, text, coalesce(octet_length(encode(text)), 0) + 16 AS size, md5(text) AS digest FROM documents
), sums AS (
  SELECT *,
    sum(size) OVER (ORDER BY digest NULLS FIRST, doc_id NULLS FIRST ROWS UNBOUNDED PRECEDING) - size AS first_byte,
    sum(size) OVER () AS all_bytes
  FROM rows_
), cut AS (
  SELECT *, (first_byte * 40 // all_bytes)::INTEGER AS shard FROM sums
)
SELECT doc_id, size::BIGINT AS size,
  {_CRC.format("coalesce(text, '')")}::BIGINT AS text_crc32,
  'bytes' AS law, shard,
  (row_number() OVER (PARTITION BY shard ORDER BY digest NULLS FIRST, doc_id NULLS FIRST) - 1)::BIGINT AS slot,
  CAST(NULL AS INTEGER) AS grown_shard
FROM cut, crc_table
"""

OP6 = rf"""
WITH split AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS pos
  FROM documents
), keyed AS (
  SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM split
), heavy AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, h.key IS NOT NULL AND k.doc_id <> h.keeper AS dropped FROM keyed k LEFT JOIN heavy h ON k.key = h.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

_WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

OP10 = rf"""
WITH items AS (
  SELECT item_id, {_WORDS.format(_LOWER.format("text"))} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, list_slice(w, i, i + 9) AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)
), docs AS (
  SELECT doc_id, coalesce({_WORDS.format(_LOWER.format("text"))}, []) AS w FROM documents
), lens AS (
  SELECT DISTINCT len(win) AS n FROM windows
), places AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lens WHERE len(w) >= n
), hits AS (
  SELECT p.doc_id, p.i, p.n, windows.item_id
  FROM (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS win FROM places) p JOIN windows USING (win)
), counted AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
  coalesce(n.n_items, 0)::BIGINT AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
  coalesce(c.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN counted c ON d.doc_id = c.doc_id LEFT JOIN named n ON d.doc_id = n.doc_id
"""

OP1 = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+') AS parts FROM documents
), worded AS (
  SELECT doc_id, list_filter(parts, lambda x: x <> '') AS w FROM docs
), sets AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1),
    lambda i: array_to_string(list_slice(w, i, i + 3), ' '))) AS s
  FROM worded WHERE len(w) > 0
), shingles AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS common
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared WHERE 100 * common >= 80 * (na + nb - common)
  UNION ALL SELECT b, a FROM shared WHERE 100 * common >= 80 * (na + nb - common)
), reach AS (
  SELECT doc_id AS node, doc_id AS reached FROM documents
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.reached
)
SELECT d.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, min(r.reached)::BIGINT AS component_id,
  d.doc_id = min(r.reached) AS kept
FROM documents d LEFT JOIN sets s ON d.doc_id = s.doc_id JOIN reach r ON d.doc_id = r.node GROUP BY d.doc_id, s.s
"""

OP2 = """
WITH RECURSIVE usable AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / sqrt(list_inner_product(a.e, a.e) * list_inner_product(b.e, b.e)) >= 0.98
), reach AS (
  SELECT vec_id AS node, vec_id AS reached FROM embeddings
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.reached
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links,
  min(r.reached)::BIGINT AS component_id, e.vec_id = min(r.reached) AS kept
FROM embeddings e JOIN reach r ON e.vec_id = r.node GROUP BY e.vec_id
"""

# Words one edit apart: equal without the character at one place, or one is the other without a character.
OP11 = rf"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT doc_id, w, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("text")}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents
  ) GROUP BY doc_id, w
), hashed AS (
  SELECT w, n, {_CRC.format("k")} AS h
  FROM (SELECT w, n, coalesce(doc_id::VARCHAR, '') || ':' || w AS k FROM runs), crc_table
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN left(w, (h % length(w))::INTEGER) || substr(w, (h % length(w))::INTEGER + 2)
      ELSE w END AS word FROM hashed
  ) GROUP BY word HAVING sum(n) >= 3 AND length(word) >= 5
), gaps AS (
  SELECT word, n, i, left(word, i::INTEGER) || substr(word, i::INTEGER + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM gaps a JOIN gaps b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON g.rest = w.word
  UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON g.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n
  FROM near GROUP BY word
), formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0)::BIGINT AS n_near, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form,
    CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END::BIGINT AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word
), reach AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT r.word, f.form FROM reach r JOIN formed f ON r.at = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN reach r ON f.word = r.word JOIN formed l ON r.at = l.word WHERE l.form IS NULL
"""

OP13 = r"""
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
    sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS d
  FROM documents
), drawn AS (
  SELECT *, len(u) AS n, ('0x' || substr(d, 1, 8))::BIGINT AS h1, ('0x' || substr(d, 9, 8))::BIGINT AS h2,
    ('0x' || substr(d, 17, 8))::BIGINT AS h3, ('0x' || substr(d, 25, 8))::BIGINT AS h4
  FROM units
), cut AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, coalesce(array_to_string(list_slice(u, 1, a), ''), '') AS p,
    coalesce(array_to_string(list_slice(u, a + 1, b), ''), '') AS m,
    coalesce(array_to_string(list_slice(u, b + 1, n), ''), '') AS s
  FROM cut
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

SQL = {
    "op1_lsh_forest": OP1, "op2_pivot_index": OP2, "op5_byte_shards": OP5, "op6_line_dedup": OP6,
    "op10_decontamination": OP10, "op11_spelling_variants": OP11, "op13_fill_in_middle": OP13,
}
