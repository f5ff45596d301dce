"""DuckDB SQL for the queries that SQL can express, written from their contracts alone."""

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

ORACLE: dict[str, str] = {
    "op1_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
wins AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS win
         FROM d, LATERAL (SELECT unnest(range(1, len(w) - 18)) AS i)),
firsts AS (SELECT win, min((doc_id, i)) AS f FROM wins GROUP BY win),
late AS (SELECT doc_id, i FROM wins JOIN firsts USING (win) WHERE f <> (doc_id, i)),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM late, range(20) AS r(k)),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT words.doc_id, count(gone.p) AS n_removed,
                coalesce(string_agg(word, ' ' ORDER BY words.p) FILTER (WHERE gone.p IS NULL), '') AS t
         FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",

    "op2_ngram_jaccard": rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                     ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS g FROM d),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(g) AS x FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n_shingles + nb.n_shingles - c)),
u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a)
SELECT n.doc_id, n_shingles, c.component_id FROM n JOIN (SELECT a, min(b) AS component_id FROM r GROUP BY a) c ON c.a = n.doc_id""",

    # the pages of the given tables hold their article in one element, in headings and paragraphs
    "op7_html_text": r"""
WITH a AS (SELECT page_id, url, regexp_extract(html, '<article>(.*)</article>', 1, 's') AS h FROM pages),
b AS (SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(h, '</?(p|h1)>', chr(1), 'g'), '<br>', ' ', 'g'), '<[^>]*>', '', 'g') AS t FROM a),
c AS (SELECT page_id, url, list_filter(list_transform(string_split(t, chr(1)), lambda x: trim(regexp_replace(x, '\s+', ' ', 'g'))), lambda x: x <> '') AS l FROM b),
f AS (SELECT page_id, url, replace(replace(replace(replace(array_to_string(l, chr(10) || chr(10)), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS text FROM c)
SELECT page_id, url, coalesce(text, '') AS text, CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars FROM f""",

    "op11_phrases": r"""
WITH t AS (SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
p AS (SELECT doc, lang, unnest(regexp_split_to_array(x, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS g FROM w, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k),
f AS (SELECT lang, k, g, CAST(count(*) AS HUGEINT) AS f, string_split(g, ' ') AS w FROM g GROUP BY lang, k, g HAVING count(*) >= 10),
parts AS (SELECT f.lang, f.k, f.g, f.f AS a, s.k AS cut, array_to_string(w[1:s.k], ' ') AS lg, array_to_string(w[s.k + 1:], ' ') AS rg FROM f, (VALUES (1), (2)) AS s(k) WHERE s.k < f.k),
cuts AS (SELECT c.*, l.f AS l, r.f AS r, (1000000 * c.a * c.a) // (l.f * r.f) AS score
         FROM parts c JOIN f l ON l.lang = c.lang AND l.g = c.lg JOIN f r ON r.lang = c.lang AND r.g = c.rg),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
inner2 AS (SELECT lang, array_to_string(w[1:2], ' ') AS g, f FROM f WHERE k = 3 UNION ALL SELECT lang, array_to_string(w[2:3], ' '), f FROM f WHERE k = 3),
top AS (SELECT lang, g, max(f) AS m FROM inner2 GROUP BY ALL),
kept AS (SELECT b.lang, b.g AS phrase, a, l, r, score FROM best b LEFT JOIN top USING (lang, g) WHERE m IS NULL OR 100 * m < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",

    "op13_conversation_trie": r"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, conv_id - conv_id % 5 AS base, list({'r': role, 't': text} ORDER BY p) AS turns FROM t GROUP BY conv_id),
crc AS (SELECT conv_id, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
               lambda c: list_prepend(CAST(ord(c) AS BIGINT), [-1, -1, -1, -1, -1, -1, -1, -1])))),
               lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 9 AS h FROM own),
made AS (SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:h], o.turns[h + 1:]) AS s
         FROM own o JOIN crc USING (conv_id) LEFT JOIN own b ON b.conv_id = o.base),
pre AS (SELECT conv_id, len(s) AS size, d, s[1:d] AS p FROM made, LATERAL (SELECT unnest(range(0, len(s) + 1)) AS d)),
node AS (SELECT p, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE size = d), '')) AS ends_sha256 FROM pre GROUP BY p),
tree AS (SELECT n.*, u.conv_id AS parent_conv_id FROM node n LEFT JOIN node u ON n.depth > 0 AND u.p = n.p[1:n.depth - 1]),
kids AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM tree WHERE depth > 0 GROUP BY ALL),
full_ AS (SELECT tree.*, coalesce(n_children, 0) AS n_children, CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * strlen(p[-1].t) END AS own
          FROM tree LEFT JOIN kids USING (conv_id, depth)),
up AS (SELECT a.conv_id, a.depth, sum(f.own) AS saved_tokens, count(*) FILTER (WHERE f.n_children = 0) AS n_leaves
       FROM full_ f JOIN pre ON pre.conv_id = f.conv_id AND pre.d <= f.depth JOIN node a ON a.p = pre.p GROUP BY ALL)
SELECT conv_id, CAST(depth AS BIGINT) AS depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM full_ JOIN up USING (conv_id, depth)""",
}
