"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

from screenrank.llm.words import WORD_PATTERN

_WORDS = f"regexp_extract_all(lower(coalesce(text, '')), '{WORD_PATTERN}')"

NGRAM_JOIN = f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
s AS (SELECT r, doc_id, list_sort(list_distinct(
        CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[])
             WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END)) AS s
      FROM w),
rep AS (SELECT s, min(r) AS rep, min(doc_id) AS copy_of, count(*) AS copies FROM s WHERE len(s) > 0 GROUP BY s),
item AS (SELECT rep, copies, len(s) AS n, unnest(s) AS x FROM rep),
link AS (SELECT a.rep AS a, b.rep AS b, any_value(b.copies) AS copies
         FROM item a JOIN item b ON a.x = b.x AND a.rep <> b.rep
         GROUP BY a.rep, b.rep
         HAVING count(*) >= 0.8 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9),
reach(a, b) AS (SELECT rep, rep FROM rep
                UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
class AS (SELECT a AS rep, min(copy_of) AS class_id FROM reach JOIN rep ON rep.rep = reach.b GROUP BY a),
cnt AS (SELECT a AS rep, sum(copies) AS docs, count(*) AS texts FROM link GROUP BY a)
SELECT s.doc_id, CASE WHEN rep.rep IS NULL THEN s.doc_id ELSE class.class_id END AS class_id,
       CASE WHEN rep.rep IS NULL THEN s.doc_id ELSE rep.copy_of END AS copy_of,
       CAST(coalesce(cnt.docs, 0) + coalesce(rep.copies, 1) - 1 AS BIGINT) AS n_links,
       CAST(coalesce(cnt.texts, 0) AS BIGINT) AS n_texts
FROM s LEFT JOIN rep ON rep.s = s.s LEFT JOIN class ON class.rep = rep.rep
LEFT JOIN cnt ON cnt.rep = rep.rep
"""

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT row_number() OVER () AS q, item_id, {_WORDS} AS w FROM benchmark),
ds AS (SELECT r, len(w) - 4 AS n, unnest(range(0, len(w) - 4)) AS pos, w FROM d WHERE len(w) >= 5),
dx AS (SELECT r, n, pos, array_to_string(w[pos+1:pos+5], ' ') AS x FROM ds),
bs AS (SELECT q, len(w) - 4 AS size, unnest(range(0, len(w) - 4)) AS pos, w FROM b WHERE len(w) >= 5),
bx AS (SELECT q, size, array_to_string(w[pos+1:pos+5], ' ') AS x, count(*) AS tf FROM bs GROUP BY ALL),
hit AS (SELECT r, q, n, size, pos, dx.x, tf FROM dx JOIN bx USING (x)),
win AS (SELECT DISTINCT r, q, n, size,
               unnest(range(greatest(pos - size + 1, 0), least(pos, greatest(n - size, 0)) + 1)) AS start
        FROM hit),
c AS (SELECT w.r, w.q, w.start, w.size, least(w.n, w.size) AS wsize, x,
             least(count(*), any_value(tf)) AS m
      FROM win w JOIN hit h ON h.r = w.r AND h.q = w.q
           AND h.pos >= w.start AND h.pos < w.start + w.size
      GROUP BY ALL),
s AS (SELECT r, q, start, CAST(sum(m) AS DOUBLE) / (size + wsize - sum(m)) AS similarity
      FROM c GROUP BY r, q, start, size, wsize),
short AS (SELECT q, len(w) AS k, array_to_string(w, ' ') AS x FROM b WHERE len(w) BETWEEN 1 AND 4),
run AS (SELECT r, k, w, unnest(range(0, len(w) - k + 1)) AS pos
        FROM d JOIN (SELECT DISTINCT k FROM short) u ON CASE WHEN k = 1 THEN len(w) = 1 ELSE len(w) >= k END),
found AS (SELECT r, q, start, similarity FROM s WHERE similarity >= 0.8
          UNION ALL SELECT r, q, pos, 1.0 FROM run JOIN short
          ON short.k = run.k AND short.x = array_to_string(w[pos+1:pos+run.k], ' '))
SELECT doc_id, item_id, max(similarity) AS similarity,
       CAST(arg_min(start, (-similarity, start)) AS BIGINT) AS start
FROM found JOIN d USING (r) JOIN b USING (q) GROUP BY doc_id, item_id
"""

TOPK_SEARCH = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(list_dot_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

LINE_DEDUP = r"""
WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw,
                  generate_subscripts(string_split(text, chr(10)), 1) - 1 AS i FROM documents),
t AS (SELECT doc_id, raw, i, trim(raw, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS x FROM l),
p AS (SELECT doc_id, i, x, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w FROM t WHERE x <> ''),
n AS (SELECT *, row_number() OVER o AS r, sum(w) OVER o AS upto FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
span AS (SELECT a.doc_id, a.r AS s, min(b.r) AS e FROM n a JOIN n b
           ON a.doc_id = b.doc_id AND b.r >= a.r AND b.upto - a.upto + a.w >= 50 GROUP BY a.doc_id, a.r
         UNION
         SELECT b.doc_id, max(a.r) AS s, b.r AS e FROM n a JOIN n b
           ON a.doc_id = b.doc_id AND b.r >= a.r AND b.upto - a.upto + a.w >= 50 GROUP BY b.doc_id, b.r),
win AS (SELECT span.doc_id, min(n.i) AS a, max(n.i) AS b, string_agg(n.x, chr(10) ORDER BY n.r) AS content
        FROM span JOIN n ON n.doc_id = span.doc_id AND n.r BETWEEN s AND e GROUP BY span.doc_id, s, e),
first AS (SELECT content, min((doc_id, a, b)) AS o FROM win GROUP BY content),
gone AS (SELECT DISTINCT win.doc_id, unnest(range(a, b + 1)) AS i FROM win JOIN first USING (content)
         WHERE win.doc_id <> o[1] OR a > o[3])
SELECT t.doc_id, CAST(count(*) AS INTEGER) AS lines, CAST(count(gone.i) AS INTEGER) AS removed,
       md5(coalesce(string_agg(t.raw, chr(10) ORDER BY t.i) FILTER (WHERE gone.i IS NULL), '')) AS kept_md5
FROM t LEFT JOIN gone ON gone.doc_id = t.doc_id AND gone.i = t.i GROUP BY t.doc_id
"""

TOKEN_COUNTS = f"""
WITH k AS (SELECT *, row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id) AS r FROM documents),
c AS (SELECT source, lang, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS blanks,
             len({_WORDS}) AS letters FROM k WHERE r = 1)
SELECT source, lang, 'blanks-1' AS version, count(*) AS docs, CAST(sum(blanks) AS BIGINT) AS tokens
FROM c GROUP BY source, lang
UNION ALL
SELECT source, lang, 'letters-1', count(*), CAST(sum(letters) AS BIGINT) FROM c GROUP BY source, lang
"""


HARD_NEGATIVES = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS a, a.vec_id AS anchor_id, a.label = c.label AS same, c.r, c.vec_id,
             CAST(list_dot_product(CAST(a.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
      FROM v a JOIN v c ON a.r <> c.r AND len(a.v) = len(c.v) WHERE a.vec_id % 100 = 0),
p AS (SELECT a, r AS positive, vec_id AS positive_id, score AS positive_score,
             row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST) AS k FROM s WHERE same),
n AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
             CAST(row_number() OVER (PARTITION BY a, positive ORDER BY score DESC, vec_id NULLS LAST) AS INTEGER) AS rank
      FROM p JOIN s USING (a)
      WHERE k <= 5 AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

_TERMS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          r"'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

LEXICAL_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
i AS (SELECT row_number() OVER () AS q, item_id, unnest(list_distinct({_TERMS})) AS t FROM benchmark),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS BIGINT) AS n_terms FROM d WHERE len(w) > 0),
p AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM d) u
      WHERE t IN (SELECT t FROM i) GROUP BY r, t),
g AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS weight
      FROM p, c GROUP BY t, n_docs),
x AS (SELECT r, doc_id, 100 - 50 + ((50 * len(w) * n_docs) // n_terms) AS m FROM d, c WHERE len(w) > 0),
a AS (SELECT p.r, p.t, weight * ((1000000000 * tf) // (1000 * tf + 20 * m)) AS adds
      FROM p JOIN g USING (t) JOIN x USING (r)),
s AS (SELECT q, item_id, r, CAST(sum(adds) AS BIGINT) AS score FROM i JOIN a USING (t) GROUP BY q, item_id, r),
k AS (SELECT q, item_id, doc_id, score, CAST(row_number() OVER (
        PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
      FROM s JOIN x USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
"""


def license_scan() -> str:
    """Single lines, SPDX lines and whole texts; groups of sentences are tested by brute force."""
    from screenrank.llm import licenses as L

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    def values(rows) -> str:
        return ", ".join("(" + ", ".join(str(x) if isinstance(x, int) else quoted(x) for x in r) + ")" for r in rows)

    n = len(L.TEMPLATES)
    texts = [(i, name, L.family(name), text) for i, (name, text) in enumerate(L.TEMPLATES)]
    texts += [(n + len(L.TITLES) + i, name, "whole", text) for i, (name, text) in enumerate(L.FULL_TEXTS)]
    named = [(k, v, q, name) for (k, v, q), name in L.named_licences().items()]
    ids = sorted({(x.lower(), x) for x in [*L.named_licences().values(), *(t for t, _ in L.TITLES)]})
    versioned = ", ".join(quoted(k) for k in sorted({k for k, _, _, _ in named}))
    words = "regexp_extract_all(lower({}), '[a-z0-9]+')"
    qualifiers = "array_to_string(list_filter([" + ", ".join(
        f"CASE WHEN regexp_matches(line, {quoted(p)}) THEN '{q}' END" for q, p in sorted(L.QUALIFIERS.items())
    ) + "], lambda x: x IS NOT NULL), ' ')"
    titles = ", ".join(quoted(" ".join(L.words(t))) for _, t in L.TITLES)
    return rf"""
WITH t(i, name, kind, text) AS (VALUES {values(texts)}),
named(kind, version, quals, licence) AS (VALUES {values(named)}),
ids(id, licence) AS (VALUES {values(ids)}),
tw AS (SELECT i, unnest({words.format('text')}) AS w FROM t),
tf AS (SELECT i, w, count(*) AS n FROM tw GROUP BY i, w),
idf AS (SELECT w, ln((1.0 + {n}) / (1 + count(*))) + 1 AS idf FROM tf WHERE i < {n} GROUP BY w),
tx AS (SELECT i, w, (1 + ln(n)) * coalesce(idf, ln(1.0 + {n}) + 1) AS x FROM tf LEFT JOIN idf USING (w)),
tv AS (SELECT i, w, x, sqrt(sum(x ** 2) OVER (PARTITION BY i)) AS norm FROM tx),
f AS (SELECT doc_id, text, coalesce(source, '_') || '/' || coalesce(lang, '_')
             || CASE WHEN doc_id % 10 = 0 THEN '' ELSE '/' || (doc_id // 1000) END AS dir FROM documents),
l AS (SELECT doc_id, unnest(string_split(lower(text), chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS k FROM f
      UNION ALL SELECT doc_id, lower(text), 0 FROM f),
lw AS (SELECT doc_id, k, unnest({words.format('line')}) AS w FROM l),
lf AS (SELECT doc_id, k, w, count(*) AS n FROM lw GROUP BY ALL),
lv AS (SELECT doc_id, k, w, (1 + ln(n)) * coalesce(idf, ln(1.0 + {n}) + 1) AS x
       FROM lf LEFT JOIN idf USING (w)),
ln AS (SELECT doc_id, k, sqrt(sum(x ** 2)) AS norm FROM lv GROUP BY doc_id, k),
c AS (SELECT lv.doc_id, lv.k, tv.i, sum(lv.x * tv.x) / any_value(ln.norm * tv.norm) AS cosine
      FROM lv JOIN tv USING (w) JOIN ln ON ln.doc_id = lv.doc_id AND ln.k = lv.k
      WHERE tv.i < {n} OR lv.k = 0 GROUP BY lv.doc_id, lv.k, tv.i),
m AS (SELECT c.*, t.name, t.kind, array_to_string(list_sort(list_distinct(list_transform(
             regexp_extract_all(line, {quoted(L.VERSION)}, 1), lambda v: regexp_replace(v, '(\.0)+$', '')))), ' ') AS version,
             {qualifiers} AS quals
      FROM c JOIN t USING (i) JOIN l ON l.doc_id = c.doc_id AND l.k = c.k WHERE cosine >= {L.THRESHOLD} - 1e-9),
s AS (SELECT m.doc_id, m.k, m.i, m.cosine, CASE
             WHEN m.kind = 'whole' THEN name WHEN m.kind IN ({versioned}) THEN named.licence
             WHEN m.version = '' AND m.quals = '' THEN name END AS licence
      FROM m LEFT JOIN named ON named.kind = m.kind AND named.version = m.version AND named.quals = m.quals
      UNION ALL
      SELECT doc_id, k, 1000, 1.0, ids.licence FROM l
      JOIN ids ON ids.id = regexp_replace(regexp_extract(line, {quoted(L.SPDX)}, 1), '(-only|-or-later|\+)$', '') WHERE k > 0),
o AS (SELECT doc_id, arg_min(licence, (-round(cosine, 9), i, k)) AS name, bool_or(k = 0) AS all_of_it
      FROM s WHERE licence IS NOT NULL GROUP BY doc_id),
own AS (SELECT f.*, o.name, coalesce(o.all_of_it, false)
               OR array_to_string({words.format("coalesce(text, '')")}, ' ') IN ({titles}) AS grants
        FROM f LEFT JOIN o USING (doc_id)),
g AS (SELECT dir AS above, arg_min(name, dir || '/' || doc_id) AS name FROM own
      WHERE grants AND name IS NOT NULL GROUP BY dir),
n AS (SELECT x.dir, arg_max(g.name, length(g.above)) AS name FROM (SELECT DISTINCT dir FROM own) x
      JOIN g ON x.dir = g.above OR starts_with(x.dir, g.above || '/') GROUP BY x.dir)
SELECT doc_id, coalesce(own.name, n.name) AS license,
       CASE WHEN own.name IS NOT NULL THEN 'own' WHEN n.name IS NOT NULL THEN 'inherited' END AS via
FROM own LEFT JOIN n ON n.dir = own.dir
"""
