"""The operators' results as DuckDB SQL, written from their definitions."""

#: The clauses before the last SELECT; ``deduped`` has doc_id, text, n_lines, n_removed_lines.
LINE_WINDOWS_CTES = r"""
source AS (SELECT * FROM documents),
lined AS (
  SELECT doc_id, text, coalesce(text, '') AS body, string_split(coalesce(text, ''), chr(10)) AS lines
  FROM source
),
line_rows AS (
  SELECT DISTINCT doc_id, body, unnest(range(1, len(lines) + 1)) AS line_no, unnest(lines) AS line FROM lined
),
full_rows AS (
  SELECT *, row_number() OVER w - 1 AS k, lead(line, 1) OVER w AS l2, lead(line, 2) OVER w AS l3
  FROM line_rows WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
  WINDOW w AS (PARTITION BY doc_id, body ORDER BY line_no)
),
windows AS (
  SELECT doc_id, body, k, row_number() OVER (PARTITION BY line, l2, l3 ORDER BY doc_id NULLS FIRST, body, k) AS nth
  FROM full_rows WHERE l3 IS NOT NULL
),
cut AS (
  SELECT DISTINCT doc_id, body, k + unnest([0, 1, 2]) AS k FROM windows WHERE nth > 1
),
marked AS (
  SELECT r.doc_id, r.body, r.line_no, r.line, f.k IS NOT NULL AS is_full, c.k IS NOT NULL AS is_cut
  FROM line_rows r
  LEFT JOIN full_rows f ON f.doc_id IS NOT DISTINCT FROM r.doc_id AND f.body = r.body AND f.line_no = r.line_no
  LEFT JOIN cut c ON c.doc_id IS NOT DISTINCT FROM r.doc_id AND c.body = r.body AND c.k = f.k
),
folded AS (
  SELECT doc_id, body, count(*) FILTER (is_full) AS n_lines, count(*) FILTER (is_cut) AS n_removed_lines,
         coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT is_cut), '') AS kept
  FROM marked GROUP BY doc_id, body
)"""

LINE_WINDOWS_SQL = f"""
WITH {LINE_WINDOWS_CTES}
SELECT s.doc_id, f.n_lines, f.n_removed_lines, md5(f.kept) AS kept_md5
FROM source s JOIN folded f ON f.doc_id IS NOT DISTINCT FROM s.doc_id AND f.body = coalesce(s.text, '')
"""

#: Bytes as pairs of hexadecimal digits; ``n`` counts rows, as doc_ids may repeat.
SUFFIX_RANKS_SQL = r"""
WITH source AS (
  SELECT row_number() OVER () AS n, doc_id, coalesce(doc_id, 9223372036854775807) AS place,
         hex(encode(coalesce(text, ''))) AS raw
  FROM documents
),
strings AS (
  SELECT n, place, i, raw[2 * i + 1 : 2 * i + 100] AS s
  FROM (SELECT n, place, raw, unnest(range(0, greatest(len(raw) // 2 - 49, 0))) AS i FROM source)
),
repeated AS (
  SELECT n, i FROM (SELECT n, place, i, min(place) OVER (PARTITION BY s) AS earliest FROM strings)
  WHERE earliest < place
),
gone AS (SELECT DISTINCT n, i + j AS i FROM repeated, range(0, 50) t(j)),
spans AS (
  SELECT n, count(*) AS n_removed, count(*) FILTER (first) AS n_spans
  FROM (SELECT n, coalesce(i <> lag(i) OVER (PARTITION BY n ORDER BY i) + 1, true) AS first FROM gone) GROUP BY n
),
rest AS (
  SELECT b.n, string_agg(b.pair, '' ORDER BY b.i) AS kept
  FROM (SELECT n, i, raw[2 * i + 1 : 2 * i + 2] AS pair
        FROM (SELECT n, raw, unnest(range(0, len(raw) // 2)) AS i FROM source)) b
  ANTI JOIN gone USING (n, i) GROUP BY b.n
)
SELECT doc_id, CAST(len(raw) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM source LEFT JOIN spans USING (n) LEFT JOIN rest USING (n)
"""

PHRASE_AUTOMATA_SQL = r"""
WITH source AS (
  SELECT row_number() OVER () AS n, doc_id,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
windows AS (
  SELECT n, i, array_to_string(words[i : i + 34], ' ') AS s
  FROM (SELECT n, words, unnest(range(1, greatest(len(words) - 33, 1))) AS i FROM source)
),
repeated AS (SELECT n, i FROM (SELECT n, i, count(*) OVER (PARTITION BY s) AS times FROM windows) WHERE times > 1),
gone AS (SELECT DISTINCT n, i + j AS i FROM repeated, range(0, 35) t(j)),
removed AS (SELECT n, count(*) AS n_removed FROM gone GROUP BY n),
rest AS (
  SELECT b.n, string_agg(b.word, ' ' ORDER BY b.i) AS kept
  FROM (SELECT n, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS i FROM source) b
  ANTI JOIN gone USING (n, i) GROUP BY b.n
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM source LEFT JOIN removed USING (n) LEFT JOIN rest USING (n)
"""

LSH_FOREST_SQL = r"""
WITH RECURSIVE source AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM source WHERE len(words) > 0)
),
sizes AS (SELECT doc_id, count(*) AS size FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
           FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
near AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
         WHERE 100 * common >= 80 * (x.size + y.size - common)),
links AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
reach AS (SELECT doc_id AS a, doc_id AS b FROM source UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM source JOIN roots USING (doc_id) LEFT JOIN sizes USING (doc_id)
"""

LEXICAL_SEARCH_SQL = r"""
WITH source AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
sizes AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n FROM source WHERE len(terms) > 0),
all_docs AS (SELECT CAST(count(*) AS BIGINT) AS big_n, CAST(sum(n) AS BIGINT) AS big_l FROM sizes),
times AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM source) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM times, all_docs GROUP BY term
),
asked AS (
  SELECT q, item_id, term, count(*) AS repeats
  FROM (SELECT row_number() OVER () AS q, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
),
scores AS (
  SELECT q, item_id, r, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN times USING (term)
  JOIN (SELECT r, doc_id, 100 - 25 + (25 * n * big_n) // big_l AS m FROM sizes, all_docs) USING (r)
  GROUP BY q, item_id, r, doc_id
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS place FROM scores WHERE score > 0)
WHERE place <= 20
"""

#: The checksum is worked out bit by bit, as there is no function for it.
CONVERSATION_TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
),
lists AS (
  SELECT conv_id, list({'role': role, 'text': text}
         ORDER BY turn NULLS FIRST, md5(length(role) || ':' || role || text)) AS l
  FROM turns GROUP BY conv_id
),
bits AS (
  SELECT conv_id, l, list_transform(range(0, 8 * length(CAST(conv_id AS VARCHAR))),
         lambda i: (ascii(CAST(conv_id AS VARCHAR)[i // 8 + 1]) >> CAST(i % 8 AS INTEGER)) & 1) AS bit
  FROM lists
),
convs AS (
  SELECT conv_id, l, conv_id - conv_id % 20 AS donor,
         xor(list_reduce(list_prepend(4294967295, list_transform(bit, lambda b: CAST(b AS BIGINT))),
             lambda c, b: xor(c >> 1, CASE WHEN xor(c, b) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295) % 4 AS h
  FROM bits
),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(d.l, [])[1:h], c.l[h + 1:]) AS l
  FROM convs c LEFT JOIN lists d ON d.conv_id = c.donor
),
prefixes AS (
  SELECT conv_id, d AS depth, l[1:d] AS prefix, len(l) = d AS ends
  FROM (SELECT conv_id, l, unnest(range(0, len(l) + 1)) AS d FROM rebuilt)
),
nodes AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS members
  FROM prefixes GROUP BY prefix, depth
),
children AS (
  SELECT prefix[1:depth - 1] AS prefix, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
),
valued AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         (n_convs - 1) * CASE WHEN depth = 0 THEN 0
           ELSE len(list_filter(string_split_regex(n.prefix[depth].text, '[\x20\x09-\x0D]+'), lambda w: w <> '')) END AS saved
  FROM nodes n LEFT JOIN children c ON c.prefix = n.prefix
),
totals AS (
  SELECT prefix[1:k] AS prefix, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT prefix, n_children, saved, unnest(range(0, depth + 1)) AS k FROM valued) GROUP BY 1
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves,
       CAST(t.saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(v.members, '')) AS ends_sha256
FROM valued v JOIN totals t ON t.prefix = v.prefix
LEFT JOIN nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.prefix = v.prefix[1:v.depth - 1]
"""
