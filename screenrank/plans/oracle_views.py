"""SQL (DuckDB dialect) definitions of the fixture views, used by oracles.

They restate ``screenrank.sources.fixtures`` in SQL over the same Parquet
tables so every registered query has an independent cross-check.
"""

STAR_RATINGS = """star_ratings AS (
  SELECT o.o_custkey AS uid, l.l_partkey AS mid,
         CAST(ceil(l.l_quantity / 5) AS DOUBLE) / 2 AS score,
         CAST(floor(epoch(o.o_orderdate)) AS BIGINT) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

EVENT_RATINGS = """event_ratings AS (
  SELECT * FROM (
    SELECT user_id AS uid,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS mid,
           CAST(CASE event_type WHEN 'purchase' THEN 5.0 WHEN 'signup' THEN 4.5
                WHEN 'click' THEN 3.5 WHEN 'view' THEN 2.5 WHEN 'error' THEN 1.0 END AS DOUBLE) AS score,
           CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp",
           event_id
    FROM events) e
  WHERE score IS NOT NULL AND mid IS NOT NULL)"""

EVENT_TAGS = """event_tags AS (
  SELECT user_id AS uid, CAST(json_extract_string(props, '$.k') AS BIGINT) AS mid,
         event_type AS tag, CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
  FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL)"""

PART_MOVIES = """part_movies AS (
  SELECT p_partkey AS mid, p_name AS name, '' AS descri, '' AS timelong, '' AS issue,
         '' AS shoot, p_brand AS language,
         concat_ws('|', p_type, replace(p_name, ' ', '|')) AS genres,
         '' AS actors, '' AS directors
  FROM part)"""


def with_views(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"

# HashingTF(numFeatures=50) bucket of every term the part-movie
# fixture produces (Spark ML murmur3, measured; DuckDB has no such hash).
HASHING_TF_50_BUCKETS = {
    "anvil": 44, "blue": 18, "bolt": 40, "cold": 20, "economy": 17, "gear": 45, "gizmo": 42,
    "hot": 43, "large": 22, "medium": 42, "new": 35, "old": 33, "plate": 25, "promo": 49,
    "red": 2, "ring": 46, "rod": 32, "small": 22, "standard": 17, "widget": 19,
}


def _bucket_values() -> str:
    rows = ", ".join(f"('{t}', {b})" for t, b in HASHING_TF_50_BUCKETS.items())
    return f"(SELECT * FROM (VALUES {rows}) AS b(term, idx))"


# TF-IDF of part movies (Tokenizer -> HashingTF(50) -> IDF fitted on all parts).
TFIDF = f"""buckets AS {_bucket_values()},
toks AS (
  SELECT mid, unnest(string_split(lower(replace(genres, '|', ' ')), ' ')) AS term FROM part_movies),
tf AS (
  SELECT t.mid, b.idx, count(*) AS tf FROM toks t JOIN buckets b ON t.term = b.term
  GROUP BY t.mid, b.idx),
ndoc AS (SELECT count(*) AS n FROM part_movies),
dfreq AS (SELECT idx, count(*) AS df FROM tf GROUP BY idx),
tfidf AS (
  SELECT tf.mid, tf.idx, tf.tf * ln((ndoc.n + 1.0) / (dfreq.df + 1.0)) AS w
  FROM tf JOIN dfreq ON tf.idx = dfreq.idx CROSS JOIN ndoc)"""

# Content similarity edges, cosine > 0.6, both directions, no self pairs.
CONTENT_SIM = TFIDF + """,
nz AS (SELECT mid, idx, w FROM tfidf WHERE w <> 0),
norms AS (SELECT mid, sqrt(sum(w * w)) AS norm FROM nz GROUP BY mid),
dots AS (
  SELECT a.mid, b.mid AS sim_mid, sum(a.w * b.w) AS dot
  FROM nz a JOIN nz b ON a.idx = b.idx AND a.mid <> b.mid GROUP BY a.mid, b.mid),
sim AS (
  SELECT * FROM (
    SELECT d.mid, d.sim_mid, d.dot / nullif(na.norm * nb.norm, 0) AS score
    FROM dots d JOIN norms na ON d.mid = na.mid JOIN norms nb ON d.sim_mid = nb.mid) c
  WHERE score > 0.6)"""

# Stream batch twin inputs: the latest event of each user, every event as the
# seen set, the 20 latest events as recent ratings, candidates (top 20 unseen
# similar items of the latest event's item).
STREAM_INPUTS_TMPL = """cur AS (
  SELECT uid, mid FROM (
    SELECT uid, mid, row_number() OVER (PARTITION BY uid ORDER BY {order}) AS rn
    FROM event_ratings) t WHERE rn = 1),
seen AS (SELECT DISTINCT uid, mid FROM event_ratings),
recent AS (
  SELECT uid, mid, score FROM (
    SELECT uid, mid, score,
           row_number() OVER (PARTITION BY uid ORDER BY {order}) AS rn
    FROM event_ratings) t WHERE rn <= 20),
cand_all AS (
  SELECT cur.uid, s.sim_mid AS mid, round(s.score, 6) AS score
  FROM cur JOIN sim s ON cur.mid = s.mid),
fresh AS (
  SELECT * FROM cand_all c
  WHERE NOT EXISTS (SELECT 1 FROM seen WHERE seen.uid = c.uid AND seen.mid = c.mid)),
cands AS (
  SELECT * FROM (
    SELECT uid, mid, score,
           CAST(row_number() OVER (PARTITION BY uid ORDER BY score DESC, mid) AS INTEGER) AS rank
    FROM fresh) t WHERE rank <= 20)"""

# Batch twin: events ordered by (timestamp, event_id). Stream: messages carry
# no event id, ties broken by (mid, score).
STREAM_INPUTS = STREAM_INPUTS_TMPL.replace("{order}", '"timestamp" DESC, event_id DESC')
STREAM_INPUTS_MSG = STREAM_INPUTS_TMPL.replace("{order}", '"timestamp" DESC, mid DESC, score DESC')

STREAM_SCORES = """pairs AS (SELECT c.uid, c.mid AS q, r.mid AS r, r.score AS rating
           FROM cands c JOIN recent r ON c.uid = r.uid),
gated AS (SELECT p.uid, p.q, p.rating, s.score AS sim
          FROM pairs p JOIN sim s ON s.mid = p.q AND s.sim_mid = p.r WHERE s.score > 0.7),
scores AS (
  SELECT uid, q AS mid,
         round(avg(sim * rating)
               + ln(greatest(1, count(*) FILTER (WHERE rating > 3))) / ln(10)
               - ln(greatest(1, count(*) FILTER (WHERE rating <= 3))) / ln(10), 6) AS score
  FROM gated GROUP BY uid, q)"""

EMBED = """v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"""

SPLIT = """sp AS (
  SELECT uid, mid, score, "timestamp",
         CASE WHEN CAST('0x' || substr(md5(concat_ws('|', CAST(uid AS VARCHAR), CAST(mid AS VARCHAR),
                         CAST(CAST(score * 2 AS BIGINT) AS VARCHAR), CAST("timestamp" AS VARCHAR))), 1, 12)
                   AS UBIGINT) % 1000000 < 800000
              THEN 'train' ELSE 'test' END AS split
  FROM star_ratings),
tr AS (SELECT * FROM sp WHERE split = 'train'),
te AS (SELECT * FROM sp WHERE split = 'test')"""
