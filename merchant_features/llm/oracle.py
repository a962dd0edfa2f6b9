"""SQL statements for the queries that SQL can express, each written from the contract."""

LINE_DEDUP = """
WITH line AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS body,
           generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
    FROM documents
), keyed AS (
    SELECT doc_id, pos, body,
           translate(trim(body, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM line
), held AS (
    SELECT key, min(doc_id) AS holder FROM keyed WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) > 1
), marked AS (
    SELECT k.doc_id, k.pos, k.body, coalesce(k.doc_id <> h.holder, false) AS dropped
    FROM keyed k LEFT JOIN held h ON k.key = h.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count_if(dropped)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(body, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

#: The contracts' two kinds of words, after A-Z are lower-cased.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SOLID = "regexp_extract_all(" + _LOWER + ", '[^\\x20\\x09-\\x0D]+')"
_ALNUM = "regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH item AS (
    SELECT item_id, {_ALNUM.format("text")} AS words FROM benchmark WHERE text IS NOT NULL
), pattern AS (
    SELECT DISTINCT item_id, least(10, len(words)) AS width,
           array_to_string(words[start:start + least(10, len(words)) - 1], ' ') AS body
    FROM item, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS s(start)
    WHERE len(words) > 0
), doc AS (
    SELECT doc_id, {_ALNUM.format("coalesce(text, '')")} AS words FROM documents
), places AS (
    SELECT doc_id, width, start, array_to_string(words[start:start + width - 1], ' ') AS body
    FROM doc, (SELECT DISTINCT width FROM pattern) w, unnest(range(1, len(words) - width + 2)) AS s(start)
), found AS (
    SELECT DISTINCT p.doc_id, p.start, p.width, t.item_id FROM places p JOIN pattern t USING (width, body)
), covered AS (
    SELECT doc_id, count(DISTINCT start + k) AS n_hit FROM found, unnest(range(0, width)) AS r(k) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found WHERE item_id IS NOT NULL) GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(n.n_items, 0)::BIGINT AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN covered c USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

JACCARD_JOIN = f"""
WITH RECURSIVE doc AS (
    SELECT doc_id, {_SOLID.format("coalesce(text, '')")} AS words FROM documents
), gram AS (
    SELECT DISTINCT doc_id, array_to_string(words[start:start + least(3, len(words)) - 1], ' ') AS body
    FROM doc, unnest(range(1, greatest(len(words) - 1, 2))) AS s(start) WHERE len(words) > 0
), total AS (
    SELECT doc_id, count(*) AS n FROM gram GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n
    FROM gram a JOIN gram b ON a.body = b.body AND a.doc_id <> b.doc_id GROUP BY ALL
), link AS (
    SELECT x, y FROM shared s JOIN total a ON a.doc_id = x JOIN total b ON b.doc_id = y
    WHERE 100 * s.n >= 90 * (a.n + b.n - s.n)
), reach AS (
    SELECT doc_id AS x, doc_id AS y FROM doc UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y
)
SELECT d.doc_id, coalesce(t.n, 0)::BIGINT AS n_shingles, r.least AS component_id, coalesce(l.n, 0)::BIGINT AS n_links
FROM doc d JOIN (SELECT x, min(y) AS least FROM reach GROUP BY x) r ON r.x = d.doc_id LEFT JOIN total t USING (doc_id)
LEFT JOIN (SELECT x, count(*) AS n FROM link GROUP BY x) l ON l.x = d.doc_id
"""

WARC_ZIP = """
WITH page AS (
    SELECT page_id, coalesce(html, '') AS body FROM pages
), coded AS (
    SELECT page_id, body, sha1(body) AS hex FROM page
), digest AS (
    -- 160 bits in 32 groups of five, each a letter of the base32 alphabet
    SELECT page_id, body, list_aggregate(list_transform(range(0, 32), lambda k: substr(
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               1 + (('0x' || substr(hex || '00', 1 + (k * 5) // 4, 3))::INTEGER
                    >> (12 - 5 - (k * 5) % 4)) % 32, 1)), 'string_agg', '') AS code
    FROM coded
), first AS (
    SELECT body, min(page_id) AS page_id FROM page GROUP BY body
)
SELECT d.page_id, octet_length(encode(d.body))::BIGINT AS payload_bytes, d.code AS payload_digest,
       CASE WHEN f.page_id = d.page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN f.page_id <> d.page_id THEN f.page_id END AS refers_to
FROM digest d JOIN first f USING (body)
"""

FILTER_AUDIT = r"""
WITH doc AS (
    SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), label AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), least AS (
    SELECT text, min(doc_id) AS doc_id FROM doc GROUP BY text
), failed AS (
    SELECT d.part, coalesce(l.good, false) AS good, coalesce(l.toxic, false) AS toxic,
           (CASE WHEN len(d.words) < 200 THEN ['A'] ELSE [] END)
           || (CASE WHEN 100 * len(list_distinct(d.words)) < 50 * len(d.words) THEN ['B'] ELSE [] END)
           || (CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 2 * length(d.text) THEN ['C'] ELSE [] END)
           || (CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN ['D'] ELSE [] END)
           || (CASE WHEN d.doc_id > f.doc_id THEN ['E'] ELSE [] END) AS fails
    FROM doc d JOIN least f USING (text) LEFT JOIN label l ON l.doc_id = d.doc_id
), counted AS (
    SELECT part, fails, good, toxic, count(*) AS n FROM failed GROUP BY ALL
), letter AS (
    SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), ordering AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letter a, letter b, letter c, letter d, letter e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), place AS (
    SELECT filter_order, s.step, filter_order[s.step] AS f, string_split(filter_order[:s.step - 1], '') AS earlier
    FROM ordering, unnest(range(1, 6)) AS s(step)
), seen AS (
    SELECT c.part, p.filter_order, p.step, p.f, c.fails, c.n, c.good, c.toxic,
           list_contains(c.fails, p.f) AS here, list_has_any(c.fails, p.earlier) AS gone
    FROM counted c, place p
), summed AS (
    SELECT part, filter_order, step, f,
           coalesce(sum(n) FILTER (NOT here AND NOT gone), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (here AND NOT gone), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (here AND gone), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (here AND len(fails) = 1), 0)::BIGINT AS unique_fails,
           coalesce(sum(n) FILTER (here AND NOT gone AND good), 0)::BIGINT AS good_lost,
           coalesce(sum(n) FILTER (here AND NOT gone AND toxic), 0)::BIGINT AS toxic_lost
    FROM seen GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM summed
"""

_LETTERS = "regexp_extract_all(" + _LOWER + ", '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SOURCE_DIVERGENCE = f"""
WITH doc AS (
    SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           {_LETTERS.format("coalesce(text, '')")} AS words
    FROM documents
), word AS (
    SELECT k, lang, source, unnest(words) AS term FROM doc
), kept AS (
    SELECT lang, term, count(*) AS n FROM word GROUP BY lang, term HAVING count(DISTINCT k) >= 10
), size AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM kept GROUP BY lang
), found AS (
    SELECT w.lang, w.source, w.term, count(*) AS n FROM word w JOIN kept t USING (lang, term) GROUP BY ALL
), grp AS (
    SELECT g.lang, g.source, coalesce(s.v, 0)::HUGEINT AS v,
           coalesce((SELECT sum(n) FROM found f WHERE f.lang = g.lang AND f.source = g.source), 0)::HUGEINT AS total
    FROM (SELECT DISTINCT lang, source FROM doc) g LEFT JOIN size s USING (lang)
), share AS (
    SELECT g.lang, g.source, t.term, coalesce(f.n, 0) AS n,
           1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 2)) // (g.total + 2 * g.v) AS p,
           1 + (1000000000::HUGEINT * (t.n + 2)) // (s.total + 2 * s.v) AS q
    FROM grp g JOIN kept t USING (lang) JOIN size s USING (lang) LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = t.term
), pair AS (
    SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
    FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), every_pair AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
    FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
), term AS (
    SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
    FROM share WHERE n > 0 AND p > q
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
    FROM (FROM every_pair UNION ALL FROM term)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

EMBEDDING_FOREST = """
WITH RECURSIVE vec AS (
    SELECT row_number() OVER () AS k, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), usable AS (
    SELECT * FROM vec
    WHERE vec_id IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0
), link AS (
    SELECT a.k AS x, b.k AS y FROM usable a JOIN usable b ON a.k <> b.k AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.95
), reach AS (
    SELECT k AS x, k AS y FROM vec UNION SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y
), component AS (
    SELECT r.x AS k, min(v.vec_id) AS component_id FROM reach r JOIN vec v ON v.k = r.y GROUP BY r.x
), counted AS (
    SELECT x AS k, count(*) AS n FROM link GROUP BY x
)
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, coalesce(v.vec_id = c.component_id, false) AS kept
FROM vec v JOIN component c USING (k) LEFT JOIN counted n USING (k)
"""

STATEMENTS = {
    "op2_jaccard_join": JACCARD_JOIN,
    "op4_line_dedup": LINE_DEDUP,
    "op5_decontamination": DECONTAMINATION,
    "op10_warc_zip": WARC_ZIP,
    "op11_filter_audit": FILTER_AUDIT,
    "op12_source_divergence": SOURCE_DIVERGENCE,
    "op13_embedding_forest": EMBEDDING_FOREST,
}
