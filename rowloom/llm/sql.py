"""The queries that SQL can express, in DuckDB's dialect."""

from rowloom.llm.licenses import PHRASES, SHARE, TEMPLATES

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = r"regexp_extract_all(" + LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
PLAIN = r"regexp_extract_all(" + LOWER + r", '[^\x20\x09-\x0D]+')"
TEXT = "coalesce(text, '')"

OP5 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {ALNUM.format(TEXT)} AS w FROM documents),
     items AS (SELECT item_id, w, least(10, len(w)) AS n
               FROM (SELECT item_id, {ALNUM.format(TEXT)} AS w FROM benchmark) WHERE len(w) > 0 AND item_id IS NOT NULL),
     windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
                 FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM items)),
     places AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
                FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
                      FROM docs CROSS JOIN (SELECT DISTINCT n FROM items) WHERE len(w) >= n)),
     found AS (SELECT r, i, n, item_id FROM places JOIN windows USING (n, k)),
     hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS p FROM found) GROUP BY r),
     listed AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS all_items
                FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM found) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(all_items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM docs LEFT JOIN hit USING (r) LEFT JOIN listed USING (r)"""

_phrases = ", ".join(f"('{p}', {len(p.split())}, '{label}')" for p, label in PHRASES.items())
_templates = ", ".join(f"({i}, '{label}', list_distinct({ALNUM.format(repr(text))}))" for i, (label, text) in enumerate(TEMPLATES))

OP9 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {TEXT} AS t, {ALNUM.format(TEXT)} AS w FROM documents),
     phrases(phrase, n, label) AS (VALUES {_phrases}),
     templates(i, label, own) AS (VALUES {_templates}),
     places AS (SELECT r, i - 1 AS start, label
                FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs) JOIN phrases ON w[i] = split_part(phrase, ' ', 1)
                WHERE array_to_string(w[i:i + n - 1], ' ') = phrase),
     base AS (SELECT r, count(*) AS n_base, min(start) AS first_word, max(start) AS last_word,
                     string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM places GROUP BY r),
     lines AS (SELECT r, list_distinct({ALNUM.format('line')}) AS have FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)),
     held AS (SELECT r, label, len(list_intersect(own, have)) / len(own) AS part
              FROM lines JOIN templates ON list_has_any(own, have)
              WHERE len(list_intersect(own, have)) >= {SHARE} * len(own) - 1e-9),
     labelled AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
                  FROM (SELECT r, label FROM held UNION ALL SELECT r, label FROM places) GROUP BY r),
     best AS (SELECT r, max(part) AS part FROM held GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CASE WHEN n_base IS NOT NULL THEN 1.0::DOUBLE ELSE coalesce(part, 0.0)::DOUBLE END AS score
FROM docs LEFT JOIN base USING (r) LEFT JOIN labelled USING (r) LEFT JOIN best USING (r)"""

OP10 = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, {PLAIN.format(TEXT)} AS w FROM documents),
     sets AS (SELECT DISTINCT r, array_to_string(w[i:i + 3], ' ') AS s
              FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM docs)),
     sizes AS (SELECT r, count(*) AS n FROM sets GROUP BY r),
     shared AS (SELECT a.r AS a, b.r AS b, count(*) AS common FROM sets a JOIN sets b ON a.s = b.s AND a.r <> b.r GROUP BY ALL),
     links AS (SELECT a, b FROM shared JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b
               WHERE 100 * common >= 85 * (x.n + y.n - common)),
     reach(a, b) AS (SELECT r, r FROM docs UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id
FROM docs d JOIN reach ON reach.a = d.r JOIN docs o ON o.r = reach.b LEFT JOIN sizes ON sizes.r = d.r GROUP BY d.r, d.doc_id"""

OP12 = f"""
WITH crc_table AS (SELECT list(v ORDER BY n) AS crcs FROM (
         SELECT n, list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
         FROM (SELECT unnest(range(256)) AS n))),
     docs AS (SELECT row_number() OVER () AS r, doc_id, {ALNUM.format(TEXT)} AS w FROM documents),
     own AS (SELECT r, unnest(w) AS f FROM docs),
     aimed AS (SELECT unnest({ALNUM.format(TEXT)}) AS f FROM benchmark),
     known AS (SELECT f, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(CAST(strlen(f) AS BIGINT)), lambda i:
                   16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)),
                   lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) % 10000 AS bucket
               FROM (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM own UNION SELECT f FROM aimed)), crc_table),
     s AS (SELECT bucket, count(*) AS n FROM own JOIN known USING (f) GROUP BY bucket),
     t AS (SELECT bucket, count(*) AS n FROM aimed JOIN known USING (f) GROUP BY bucket),
     gains AS (SELECT bucket, CAST(floor(1000 * ln(
                   (CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (CAST(coalesce((SELECT sum(n) FROM s), 0) AS DOUBLE) + 10000)
                   / ((CAST(s.n AS DOUBLE) + 1) * (CAST(coalesce((SELECT sum(n) FROM t), 0) AS DOUBLE) + 10000)))) AS BIGINT) AS gain
               FROM s LEFT JOIN t USING (bucket)),
     means AS (SELECT r, count(*) AS n, sum(gain) AS total FROM own JOIN known USING (f) JOIN gains USING (bucket) GROUP BY r),
     noise AS (SELECT r, doc_id, len(w) AS words, CAST(floor(-1000 * ln(-ln((CAST(list_reduce(list_prepend(0, list_transform(range(8), lambda i:
                   instr('0123456789abcdef', h[i + 1]) - 1)), lambda c, b: 16 * c + b) AS DOUBLE) + 0.5) / 4294967296.0))) AS BIGINT) AS g
               FROM (SELECT *, sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM docs)),
     scored AS (SELECT r, doc_id, words, coalesce(n, 0) AS n_features,
                       CAST(coalesce((total - ((total % n) + n) % n) // n, 0) AS BIGINT) AS weight, g FROM noise LEFT JOIN means USING (r)),
     drawn AS (SELECT r, row_number() OVER (ORDER BY weight + g DESC, doc_id NULLS LAST) AS k FROM scored WHERE words >= 20)
SELECT doc_id, n_features, weight, weight + g AS score, CASE WHEN k <= (SELECT count(*) FROM drawn) * 10 // 100 THEN k END AS rank
FROM scored LEFT JOIN drawn USING (r)"""

LETTERS = r"regexp_extract_all(" + LOWER + r", '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"

OP13 = f"""
WITH docs AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {LETTERS.format(TEXT)} AS w FROM documents),
     occ AS (SELECT r, lang, source, unnest(w) AS term FROM docs),
     kept AS (SELECT lang, term, count(*) AS n FROM occ GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
     langs AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
     cells AS (SELECT lang, source, term, count(*) AS n FROM occ JOIN kept USING (lang, term) GROUP BY ALL),
     sides AS (SELECT lang, source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM docs)
               LEFT JOIN cells USING (lang, source) GROUP BY ALL),
     prices AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
                       1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 1)) // (s.n + v)::HUGEINT AS p,
                       1 + (1000000000::HUGEINT * (k.n + 1)) // (l.n + v)::HUGEINT AS q
                FROM sides s JOIN langs l ON s.lang = l.lang JOIN kept k ON k.lang = s.lang
                     LEFT JOIN cells c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
     met AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
             FROM prices a JOIN prices b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     result AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
                FROM sides a JOIN sides b ON a.lang = b.lang AND a.source <> b.source
                LEFT JOIN met m ON m.lang = a.lang AND m.source = a.source AND m.item = b.source
                UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM prices WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM result)
WHERE part = 'pair' OR rank <= 200"""

ALL = {"op5_decontaminate": OP5, "op9_licenses": OP9, "op10_near_copies": OP10, "op12_resampling": OP12, "op13_divergence": OP13}
