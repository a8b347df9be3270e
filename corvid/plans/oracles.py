"""DuckDB-runnable SQL twins of the registered queries.

The fixture derivations of ``corvid.sources.fixtures`` appear here as CTEs
so each oracle reads only the shared tables.  Column names and rounding
match the Spark side exactly.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

# ----------------------------------------------------------------- fixtures

LOG_CTE = """
log AS (
  SELECT 'h' || CAST(user_id AS VARCHAR) || '.net.' ||
         (CASE user_id % 4 WHEN 0 THEN 'de' WHEN 1 THEN 'ca' WHEN 2 THEN 'sg' ELSE 'com' END) AS host,
         strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400' AS ts_text,
         CAST(day(ts) AS INTEGER) AS day,
         CAST(hour(ts) AS INTEGER) AS hour,
         'GET /' || event_type || ' HTTP/1.0' AS request,
         200 AS status,
         CASE WHEN event_type = 'error' THEN NULL ELSE CAST(event_id AS INTEGER) END AS bytes,
         event_id, event_type
  FROM events
),
plog AS (
  SELECT *, regexp_extract(host, '\\.([^.]+)$', 1) AS country FROM log
),
clog AS (
  SELECT * FROM plog WHERE country IN ('de', 'ca', 'sg')
),
hc AS (
  SELECT country, host, COUNT(*) AS requests FROM clog GROUP BY country, host
),
besthost AS (
  SELECT country, host, requests FROM (
    SELECT *, row_number() OVER (PARTITION BY country ORDER BY requests DESC, host) AS rn FROM hc
  ) WHERE rn = 1
)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes) + "\n"


# --------------------------------------------------------------------- logs

ORACLES["log_parse"] = _with(LOG_CTE) + """
SELECT host, ts_text, day, hour, request, status, bytes, TRUE AS well_formed, country FROM plog
"""

ORACLES["log_parse_positional"] = _with(LOG_CTE) + """
SELECT host,
       '[' || ts_text || ']' AS timestamp,
       '"GET' AS method,
       status,
       bytes,
       10 AS n_fields,
       country
FROM plog
"""

ORACLES["host_suffix_filter"] = _with(LOG_CTE) + "SELECT host, country, ts_text FROM clog"

ORACLES["country_requests"] = _with(LOG_CTE) + "SELECT country, COUNT(*) AS requests FROM clog GROUP BY country"

ORACLES["country_unique_hosts"] = _with(LOG_CTE) + """
SELECT country, COUNT(DISTINCT host) AS unique_hosts FROM clog GROUP BY country
"""

ORACLES["country_summary"] = _with(LOG_CTE) + """
SELECT country, COUNT(*) AS requests, COUNT(DISTINCT host) AS unique_hosts FROM clog GROUP BY country
"""

_TOP_HOSTS = """
SELECT country, rank, host, requests FROM (
  SELECT country, host, requests,
         CAST(row_number() OVER (PARTITION BY country ORDER BY requests DESC, host) AS INTEGER) AS rank
  FROM hc
) WHERE rank <= 9
"""
ORACLES["top_hosts"] = _with(LOG_CTE) + _TOP_HOSTS
ORACLES["top_hosts_dedup"] = _with(LOG_CTE) + _TOP_HOSTS

ORACLES["host_share"] = _with(LOG_CTE) + """
, ranked AS (
  SELECT country, host, requests,
         CAST(row_number() OVER (PARTITION BY country ORDER BY requests DESC, host) AS INTEGER) AS rank
  FROM hc
), tot AS (SELECT country, SUM(requests) AS total FROM hc GROUP BY country),
slices AS (
  SELECT country, rank, host, requests FROM ranked WHERE rank <= 9
  UNION ALL
  SELECT r.country, 10 AS rank, 'Rest' AS host, CAST(t.total - SUM(r.requests) AS BIGINT) AS requests
  FROM ranked r JOIN tot t USING (country) WHERE r.rank <= 9 GROUP BY r.country, t.total
)
SELECT s.country, s.rank, s.host, s.requests,
       round(CAST(100.0 * s.requests / t.total AS DOUBLE), 1) AS pct,
       s.requests = max(s.requests) OVER (PARTITION BY s.country) AS is_largest
FROM slices s JOIN tot t USING (country)
"""

ORACLES["top_host"] = _with(LOG_CTE) + "SELECT country, host, requests FROM besthost"

ORACLES["day_range"] = _with(LOG_CTE) + """
SELECT country, min(day) AS min_day, max(day) AS max_day FROM clog GROUP BY country
"""

ORACLES["heatmap_country"] = _with(LOG_CTE) + """
SELECT country, day, hour, COUNT(*) AS visits FROM clog GROUP BY country, day, hour
"""

ORACLES["heatmap_top_host"] = _with(LOG_CTE) + """
SELECT c.country, c.host, c.day, c.hour, COUNT(*) AS visits
FROM clog c SEMI JOIN besthost b ON c.country = b.country AND c.host = b.host
GROUP BY c.country, c.host, c.day, c.hour
"""

ORACLES["heatmap_dense"] = _with(LOG_CTE) + """
, cnt AS (
  SELECT c.country, c.host, c.day, c.hour, COUNT(*) AS visits
  FROM clog c SEMI JOIN besthost b ON c.country = b.country AND c.host = b.host
  GROUP BY c.country, c.host, c.day, c.hour
), rng AS (SELECT country, host, min(day) AS lo, max(day) AS hi FROM cnt GROUP BY country, host),
grid AS (
  SELECT country, host, CAST(d.generate_series AS INTEGER) AS day, CAST(h.generate_series AS INTEGER) AS hour
  FROM rng, generate_series(rng.lo, rng.hi) d, generate_series(0, 23) h
)
SELECT g.country, g.host, g.day, g.hour, CAST(coalesce(c.visits, 0) AS BIGINT) AS visits
FROM grid g LEFT JOIN cnt c USING (country, host, day, hour)
"""

ORACLES["heatmap_pivot"] = _with(LOG_CTE) + (
    "SELECT country, hour, "
    + ", ".join(f"CAST(SUM(CASE WHEN day = {d} THEN 1 END) AS BIGINT) AS d{d}" for d in range(1, 32))
    + " FROM clog GROUP BY country, hour"
)


# ---------------------------------------------------------------- sampling

CLAIMS_CTE = """
claims AS (
  SELECT o.o_orderkey, l.ClaimNb, CAST(l.ClaimNb >= 3 AS INTEGER) AS hasClaim, l.Exposure,
         o.o_totalprice, c.c_acctbal, o.o_orderpriority, o.o_orderstatus, c.c_mktsegment
  FROM orders o
  JOIN (SELECT l_orderkey,
               CAST(SUM(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS ClaimNb,
               round(SUM(l_quantity) / 500.0, 4) AS Exposure
        FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
)
"""

RATINGS_CTE = """
ratings AS (
  SELECT CAST(o.o_custkey AS INTEGER) AS userId,
         CAST(l.l_partkey AS INTEGER) AS movieId,
         CAST(0.5 * (1 + floor((l.l_quantity - 1) / 5)) AS DOUBLE) AS rating,
         CAST(epoch(o.o_orderdate) AS BIGINT) AS timestamp
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)
"""

SEED = 4711
M32 = 1 << 32


def hash_sql(key: str, seed: int | str | None = SEED) -> str:
    k = f"CAST({key} AS VARCHAR)"
    if seed is not None:
        k = f"'{seed}|' || {k}"
    return f"CAST(('0x' || substr(md5({k}), 1, 8)) AS BIGINT)"


def _t(f: float) -> int:
    return int(min(max(f, 0.0), 1.0) * M32)


ORACLES["claims_label"] = _with(CLAIMS_CTE) + "SELECT o_orderkey, ClaimNb, hasClaim FROM claims"

ORACLES["class_counts"] = _with(CLAIMS_CTE) + "SELECT hasClaim, COUNT(*) AS n FROM claims GROUP BY hasClaim"

ORACLES["class_proportions"] = _with(CLAIMS_CTE) + """
SELECT hasClaim, n, round(n / SUM(n) OVER (), 6) AS share
FROM (SELECT hasClaim, COUNT(*) AS n FROM claims GROUP BY hasClaim)
"""

ORACLES["class_weights"] = _with(CLAIMS_CTE) + """
, w AS (
  SELECT hasClaim, SUM(n) OVER () / (COUNT(*) OVER () * n) AS classWeights
  FROM (SELECT hasClaim, COUNT(*) AS n FROM claims GROUP BY hasClaim)
)
SELECT c.hasClaim, c.o_orderkey, round(w.classWeights, 6) AS classWeights
FROM claims c LEFT JOIN w USING (hasClaim)
"""

ORACLES["hash_split"] = _with(CLAIMS_CTE) + f"""
SELECT o_orderkey, hasClaim,
       CASE WHEN {hash_sql('o_orderkey')} < {_t(0.7)} THEN 'train' ELSE 'test' END AS split
FROM claims
"""

ORACLES["hash_sample"] = _with(CLAIMS_CTE) + f"""
SELECT o_orderkey, hasClaim FROM claims WHERE {hash_sql('o_orderkey', f'{SEED}sample')} < {_t(0.1)}
"""

ORACLES["stratified_sample"] = _with(CLAIMS_CTE) + f"""
SELECT o_orderkey, hasClaim FROM claims
WHERE {hash_sql('o_orderkey', f'{SEED}strata')} < CASE hasClaim WHEN 0 THEN {_t(0.2)} WHEN 1 THEN {_t(0.5)} ELSE 0 END
"""

ORACLES["stratified_split"] = _with(CLAIMS_CTE) + f"""
SELECT o_orderkey, hasClaim,
       CASE WHEN rn <= floor(CAST(0.7 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS split
FROM (
  SELECT o_orderkey, hasClaim,
         row_number() OVER (PARTITION BY hasClaim ORDER BY {hash_sql('o_orderkey')}, o_orderkey) AS rn,
         COUNT(*) OVER (PARTITION BY hasClaim) AS n
  FROM claims
)
"""

ORACLES["kfold_assign"] = _with(CLAIMS_CTE) + f"""
SELECT o_orderkey, hasClaim, CAST({hash_sql('o_orderkey', f'{SEED}fold')} % 5 AS INTEGER) AS fold FROM claims
"""

ORACLES["union_strata"] = _with(CLAIMS_CTE) + f"""
SELECT o_orderkey, hasClaim FROM claims WHERE hasClaim = 1 AND {hash_sql('o_orderkey', f'{SEED}sample')} < {_t(0.5)}
UNION ALL
SELECT o_orderkey, hasClaim FROM claims WHERE hasClaim = 0 AND {hash_sql('o_orderkey', f'{SEED}sample')} < {_t(0.2)}
"""

_RANKED = """
, ranked AS (
  SELECT *, row_number() OVER (ORDER BY timestamp, userId, movieId, rating) AS rn, COUNT(*) OVER () AS n
  FROM ratings
)
"""

ORACLES["chrono_split"] = _with(RATINGS_CTE) + _RANKED + """
SELECT userId, movieId, rating, timestamp,
       rn <= floor(CAST(0.4 AS DOUBLE) * n) AS train_40,
       rn <= floor(CAST(0.6 AS DOUBLE) * n) AS train_60,
       rn <= floor(CAST(0.8 AS DOUBLE) * n) AS train_80
FROM ranked
"""

ORACLES["except_distinct"] = _with(RATINGS_CTE) + _RANKED + """
SELECT userId, movieId, rating, timestamp FROM ratings
EXCEPT
SELECT userId, movieId, rating, timestamp FROM ranked WHERE rn <= floor(CAST(0.4 AS DOUBLE) * n)
"""

ORACLES["distinct_rows"] = _with(RATINGS_CTE) + "SELECT DISTINCT userId, movieId, rating, timestamp FROM ratings"

ORACLES["epoch_to_ts"] = _with(RATINGS_CTE) + """
SELECT userId, movieId, timestamp, make_timestamp(timestamp * 1000000) AS ts FROM ratings
"""

# ----------------------------------------------------------------- metrics

_BASELINE = """
, scored AS (
  SELECT r.*, m.movie_mean, u.user_mean FROM ratings r
  JOIN (SELECT movieId, avg(rating) AS movie_mean FROM ratings GROUP BY movieId) m USING (movieId)
  JOIN (SELECT userId, avg(rating) AS user_mean FROM ratings GROUP BY userId) u USING (userId)
)
"""


def _reg(pred: str, setting: str | None = None) -> str:
    sel = f"'{setting}' AS setting, " if setting else ""
    return f"""
SELECT {sel}COUNT(*) AS n,
       round(sqrt(avg(({pred} - rating) * ({pred} - rating))), 8) AS rmse,
       round(avg(({pred} - rating) * ({pred} - rating)), 8) AS mse,
       round(avg(abs({pred} - rating)), 8) AS mae
FROM scored"""


ORACLES["regression_metrics"] = _with(RATINGS_CTE) + _BASELINE + _reg("movie_mean")

_REPORT = _reg("movie_mean", "movie_mean") + "\nUNION ALL" + _reg("user_mean", "user_mean")
ORACLES["metric_report"] = _with(RATINGS_CTE) + _BASELINE + _REPORT

ORACLES["metric_pivot"] = _with(RATINGS_CTE) + _BASELINE + f"""
, rep AS ({_REPORT})
SELECT metric,
       max(CASE WHEN setting = 'movie_mean' THEN value END) AS movie_mean,
       max(CASE WHEN setting = 'user_mean' THEN value END) AS user_mean
FROM (
  SELECT setting, 'rmse' AS metric, rmse AS value FROM rep
  UNION ALL SELECT setting, 'mse', mse FROM rep
  UNION ALL SELECT setting, 'mae', mae FROM rep
) GROUP BY metric
"""

SCORES_CTE = """
scores AS (
  SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS label, CAST(l_quantity AS DOUBLE) AS score FROM lineitem
)
"""

ORACLES["auc_exact"] = _with(SCORES_CTE) + """
, s AS (
  SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM scores GROUP BY score
), c AS (
  SELECT *, COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
  FROM s
)
SELECT round(SUM(pos * (neg_before + 0.5 * neg)) / (SUM(pos) * SUM(neg)), 9) AS auc,
       CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives
FROM c
"""

ORACLES["sample_of_split"] = _with(CLAIMS_CTE) + f"""
, c AS (
  SELECT CASE WHEN {hash_sql('o_orderkey')} < {_t(0.8)} THEN 'train' ELSE 'test' END AS split,
         {hash_sql('o_orderkey', f'{SEED}sample')} < {_t(0.1)} AS kept
  FROM claims
)
SELECT split, CAST(COUNT(*) AS BIGINT) AS n, CAST(SUM(kept::INT) AS BIGINT) AS kept,
       abs(SUM(kept::INT) / COUNT(*)::DOUBLE - 0.1) < 5 * sqrt(0.09 / COUNT(*)) AS rate_as_asked
FROM c GROUP BY split
"""

ORACLES["auc_near_unique"] = """
WITH scores AS (
  SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS label,
         CASE WHEN l_orderkey % 13 <> 0 THEN CAST(l_extendedprice AS DOUBLE) ELSE -1e300 END AS score FROM lineitem
), s AS (
  SELECT score, SUM(label) AS pos, SUM(1 - label) AS neg FROM scores GROUP BY score
), c AS (
  SELECT *, COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM s
)
SELECT round(SUM(pos * (neg_before + 0.5 * neg)) / (SUM(pos) * SUM(neg)), 9) AS auc,
       CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives
FROM c
"""

_HARD = """
, hp AS (SELECT label, CAST(score > 25 AS DOUBLE) AS prediction FROM scores),
cm AS (
  SELECT CAST(SUM(CASE WHEN label = 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
         CAST(SUM(CASE WHEN label <> 1 AND prediction = 1 THEN 1 ELSE 0 END) AS BIGINT) AS fp,
         CAST(SUM(CASE WHEN label <> 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS tn,
         CAST(SUM(CASE WHEN label = 1 AND prediction <> 1 THEN 1 ELSE 0 END) AS BIGINT) AS fn
  FROM hp
)
"""

ORACLES["balanced_accuracy"] = _with(SCORES_CTE) + _HARD + """
SELECT tp, fp, tn, fn, round(0.5 * (tp / (tp + fn) + tn / (tn + fp)), 9) AS balanced_accuracy FROM cm
"""

ORACLES["accuracy"] = _with(SCORES_CTE) + _HARD + """
SELECT COUNT(*) AS n, round(avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END), 9) AS accuracy FROM hp
"""


# ------------------------------------------------------ recommendation taste

CLUSTERS_CTE = """
clusters AS (
  SELECT CAST(c.c_custkey AS INTEGER) AS id, CAST(n.n_regionkey AS INTEGER) AS prediction
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
)
"""

MOVIES_CTE = """
movies AS (
  SELECT CAST(p_partkey AS INTEGER) AS movieId, p_name AS title, replace(p_name, ' ', '|') AS genres FROM part
)
"""

TASTE_CTE = """
sizes AS (SELECT prediction, COUNT(*) AS size FROM clusters GROUP BY prediction),
largest AS (SELECT prediction, size FROM sizes ORDER BY size DESC, prediction LIMIT 1),
crat AS (
  SELECT * FROM ratings
  WHERE userId IN (SELECT id FROM clusters WHERE prediction IN (SELECT prediction FROM largest))
),
high AS (
  SELECT movieId, avg(rating) AS avg_rating, COUNT(*) AS n_ratings FROM crat GROUP BY movieId HAVING avg(rating) >= 4
),
genres AS (
  SELECT m.movieId, unnest(string_split(m.genres, '|')) AS genre
  FROM movies m WHERE m.movieId IN (SELECT movieId FROM high)
)
"""

_TASTE = _with(RATINGS_CTE, CLUSTERS_CTE, MOVIES_CTE, TASTE_CTE)

ORACLES["cluster_ratings"] = _TASTE + "SELECT userId, movieId, rating, timestamp FROM crat"

ORACLES["high_rated_movies"] = _TASTE + "SELECT movieId, round(avg_rating, 6) AS avg_rating, n_ratings FROM high"

ORACLES["top_movies"] = _TASTE + """
SELECT rank, h.movieId, m.title, round(h.avg_rating, 6) AS avg_rating FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY avg_rating DESC, movieId) AS INTEGER) AS rank FROM high
) h LEFT JOIN movies m USING (movieId) WHERE rank <= 5
"""

ORACLES["movie_genres"] = _TASTE + "SELECT movieId, genre FROM genres"

ORACLES["top_genres"] = _TASTE + """
SELECT rank, genre, count FROM (
  SELECT genre, COUNT(*) AS count, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, genre) AS INTEGER) AS rank
  FROM genres GROUP BY genre
) WHERE rank <= 10
"""

ORACLES["top_clusters"] = _TASTE + """
SELECT rank, prediction, size FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY size DESC, prediction) AS INTEGER) AS rank FROM sizes
) WHERE rank <= 5
"""

ORACLES["largest_cluster"] = _TASTE + "SELECT prediction, size FROM largest"

# ---------------------------------------------------------------- k-means

KM_CTE = """
km AS (
  SELECT c.c_custkey, min(c.c_custkey) OVER (PARTITION BY n.n_regionkey) AS cluster
  FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
)
"""

ORACLES["kmeans_assign"] = _with(KM_CTE) + "SELECT c_custkey, cluster FROM km"

ORACLES["kmeans_top_clusters"] = _with(KM_CTE) + """
SELECT rank, cluster, size FROM (
  SELECT cluster, COUNT(*) AS size, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, cluster) AS INTEGER) AS rank
  FROM km GROUP BY cluster
) WHERE rank <= 5
"""

# --------------------------------------------------------------- features

_NUM = ["Exposure", "o_totalprice", "c_acctbal"]
_CAT = ["o_orderpriority", "o_orderstatus", "c_mktsegment"]

ORACLES["assemble_features"] = _with(CLAIMS_CTE) + "SELECT o_orderkey, " + ", ".join(
    f"round({c}, 6) AS f{i}" for i, c in enumerate(_NUM)
) + " FROM claims"

ORACLES["standard_scale"] = _with(CLAIMS_CTE) + "SELECT o_orderkey, " + ", ".join(
    f"round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) + 0.0 AS f{i}" for i, c in enumerate(_NUM)
) + " FROM claims"

ORACLES["scale_sd_only"] = _with(CLAIMS_CTE) + "SELECT o_orderkey, " + ", ".join(
    f"round({c} / stddev_samp({c}) OVER (), 6) + 0.0 AS f{i}" for i, c in enumerate(_NUM)
) + " FROM claims"


def _index_cte(cat: str, source: str) -> str:
    # StringIndexer orders by frequency, then by the value's text.
    return f"""
idx_{cat} AS (
  SELECT {cat} AS v, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, CAST({cat} AS VARCHAR)) - 1 AS INTEGER) AS i
  FROM {source} GROUP BY {cat}
)"""


_IDX = _CAT + ["ClaimNb"]
ORACLES["string_index"] = (
    _with(CLAIMS_CTE, *[_index_cte(c, "claims") for c in _IDX])
    + "SELECT o_orderkey, "
    + ", ".join(f"idx_{c}.i AS {c}_index" for c in _IDX)
    + " FROM claims "
    + " ".join(f"JOIN idx_{c} ON claims.{c} = idx_{c}.v" for c in _IDX)
)

ORACLES["one_hot"] = (
    _with(CLAIMS_CTE, _index_cte("o_orderpriority", "claims"))
    + "SELECT o_orderkey, "
    + ", ".join(f"CAST(CASE WHEN i = {k} THEN 1 ELSE 0 END AS DOUBLE) AS oh{k}" for k in range(5))
    + " FROM claims JOIN idx_o_orderpriority ON claims.o_orderpriority = idx_o_orderpriority.v"
)

_TRAIN_CLAIMS = f"""
train_claims AS (SELECT * FROM claims WHERE {hash_sql('o_orderkey')} < {_t(0.7)})
"""
_STATS = "stats AS (SELECT " + ", ".join(
    f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(_NUM)
) + " FROM train_claims)"
_CAT_SIZES = {"o_orderpriority": 5, "o_orderstatus": 3, "c_mktsegment": 5}


def _design_sql(encode: str) -> str:
    ctes = [CLAIMS_CTE, _TRAIN_CLAIMS, _STATS] + [_index_cte(c, "train_claims") for c in _CAT]
    cols = [f"round((claims.{c} - m{i}) / s{i}, 6) + 0.0 AS f{i}" for i, c in enumerate(_NUM)]
    pos = len(_NUM)
    for c in _CAT:
        k = _CAT_SIZES[c]
        code = f"coalesce(idx_{c}.i, {k})"
        if encode == "ordinal":
            cols.append(f"CAST({code} AS DOUBLE) AS f{pos}")
            pos += 1
        else:
            for j in range(k):
                cols.append(f"CAST(CASE WHEN {code} = {j} THEN 1 ELSE 0 END AS DOUBLE) AS f{pos}")
                pos += 1
    joins = " ".join(f"LEFT JOIN idx_{c} ON claims.{c} = idx_{c}.v" for c in _CAT)
    return _with(*ctes) + "SELECT o_orderkey, " + ", ".join(cols) + " FROM claims CROSS JOIN stats " + joins


ORACLES["ordinal_features"] = _design_sql("ordinal")
ORACLES["feature_pipeline"] = _design_sql("onehot")

# ------------------------------------------------------------------ models

ORACLES["poisson_fit"] = _with(CLAIMS_CTE) + """
SELECT o_orderpriority, round(avg(ClaimNb), 5) + 0.0 AS mean_prediction FROM claims GROUP BY o_orderpriority
"""

ORACLES["logistic_fit"] = _with(CLAIMS_CTE) + """
SELECT o_orderpriority, round(avg(hasClaim), 4) + 0.0 AS p_hat FROM claims GROUP BY o_orderpriority
"""

ORACLES["logistic_weighted"] = _with(CLAIMS_CTE) + """
, w AS (
  SELECT hasClaim, SUM(n) OVER () / (COUNT(*) OVER () * n) AS wt
  FROM (SELECT hasClaim, COUNT(*) AS n FROM claims GROUP BY hasClaim)
)
SELECT o_orderpriority, round(SUM(wt * hasClaim) / SUM(wt), 4) + 0.0 AS p_hat
FROM claims JOIN w USING (hasClaim) GROUP BY o_orderpriority
"""

ORACLES["coefficient_report"] = _with(CLAIMS_CTE) + """
, lv AS (
  SELECT o_orderpriority AS v, avg(ClaimNb) AS m,
         row_number() OVER (ORDER BY COUNT(*) DESC, o_orderpriority) AS pos,
         COUNT(*) OVER () AS k
  FROM claims GROUP BY o_orderpriority
), last AS (SELECT m FROM lv WHERE pos = k)
SELECT '(intercept)' AS term, round(ln(m), 5) + 0.0 AS coefficient FROM last
UNION ALL
SELECT lv.v, round(ln(lv.m) - ln(last.m), 5) + 0.0 FROM lv, last WHERE lv.pos < lv.k
"""

_BASE_RATE = "(SELECT round(ln(avg(hasClaim) / (1 - avg(hasClaim))), 3) + 0.0 FROM claims)"
ORACLES["logistic_l1"] = _with(CLAIMS_CTE) + f"SELECT 'l1' AS penalty, CAST(0 AS DOUBLE) AS max_abs_coefficient, {_BASE_RATE} AS intercept"
ORACLES["logistic_l2"] = _with(CLAIMS_CTE) + f"SELECT 'l2' AS penalty, CAST(0 AS DOUBLE) AS max_abs_coefficient, {_BASE_RATE} AS intercept"

_SEP_KEY = "CAST(l_orderkey AS VARCHAR) || '|' || CAST(l_linenumber AS VARCHAR) || '|' || CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR)"


def _sep_cte(threshold: float) -> str:
    return f"""
sep AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CAST(l_quantity > {threshold} AS DOUBLE) AS label,
         {hash_sql(_SEP_KEY)} AS h, {hash_sql(_SEP_KEY, f'{SEED}fold')} AS hf
  FROM lineitem
)
"""


_SEP_TEST = f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, label, label AS prediction FROM sep WHERE h >= {_t(0.8)}"
ORACLES["random_forest"] = _with(_sep_cte(25.0)) + _SEP_TEST
ORACLES["gbt"] = _with(_sep_cte(25.0)) + _SEP_TEST
ORACLES["mlp"] = _with(_sep_cte(25.0)) + _SEP_TEST
ORACLES["refit_best"] = _with(_sep_cte(40.0)) + _SEP_TEST

ORACLES["cross_validate"] = _with(_sep_cte(40.0)) + f"""
, folds AS (
  SELECT hf % 5 AS fold, avg(1.0 - label) AS neg_share FROM sep WHERE h < {_t(0.8)} GROUP BY hf % 5
)
SELECT 0 AS setting, 'maxDepth' AS param, '0' AS value, round(avg(neg_share), 6) + 0.0 AS avg_metric, FALSE AS is_best FROM folds
UNION ALL
SELECT 1, 'maxDepth', '2', CAST(1 AS DOUBLE), TRUE
"""

ORACLES["cv_pipeline"] = ORACLES["cross_validate"]

# Known answer: both classifiers separate the fixture.
ORACLES["compare_classifiers"] = """
SELECT model, metric, CAST(1 AS DOUBLE) AS value
FROM (VALUES ('random_forest'), ('gbt')) m(model), (VALUES ('balanced_accuracy'), ('auc')) t(metric)
"""

# Known answer: equal scores have an AUC of one half, and the base rate
# predicts the larger class.
ORACLES["claims_models"] = _with(CLAIMS_CTE) + """
, sizes AS (SELECT hasClaim, COUNT(*) - floor(CAST(0.7 AS DOUBLE) * COUNT(*)) AS n FROM claims GROUP BY hasClaim)
SELECT 'logistic_l1' AS model, 'auc' AS metric, CAST(0.5 AS DOUBLE) AS value
UNION ALL
SELECT 'logistic_l1', 'accuracy', round(MAX(n) / SUM(n), 6) + 0.0 FROM sizes
"""

# Known answer: on the separable fixture depth 2 wins (accuracy 1.0 vs the
# majority share for depth 0); the other params are the estimator's settings.
ORACLES["cv_report"] = """
SELECT param, value FROM (VALUES ('maxBins', '64'), ('maxDepth', '2'), ('numTrees', '5')) AS t(param, value)
"""

# --------------------------------------------------------------------- ALS

_ALS_SPLIT = """
, ranked AS (
  SELECT *, row_number() OVER (ORDER BY timestamp, userId, movieId, rating) AS rn, COUNT(*) OVER () AS n
  FROM ratings
),
train AS (SELECT * FROM ranked WHERE rn <= floor(CAST(0.8 AS DOUBLE) * n)),
test AS (SELECT DISTINCT userId, movieId FROM ranked WHERE rn > floor(CAST(0.8 AS DOUBLE) * n))
"""

ORACLES["als_known_pairs"] = _with(RATINGS_CTE) + _ALS_SPLIT + """
SELECT userId, movieId FROM test
WHERE userId IN (SELECT userId FROM train) AND movieId IN (SELECT movieId FROM train)
"""

ORACLES["als_factors"] = _with(RATINGS_CTE) + _ALS_SPLIT + """
SELECT DISTINCT userId AS id, 10 AS n_factors FROM train
"""

def _scored_count(f: float) -> str:
    return f"""(
  SELECT COUNT(*) FROM ranked t
  WHERE t.rn > floor(CAST({f} AS DOUBLE) * t.n)
    AND t.userId IN (SELECT userId FROM ranked WHERE rn <= floor(CAST({f} AS DOUBLE) * n))
    AND t.movieId IN (SELECT movieId FROM ranked WHERE rn <= floor(CAST({f} AS DOUBLE) * n)))"""


_SCORED = " UNION ALL ".join(
    f"SELECT CAST({f} AS DOUBLE) AS fraction, '{s}' AS setting, {_scored_count(f)} AS n"
    for f in (0.4, 0.6, 0.8)
    for s in ("setting1", "setting2")
)
ORACLES["als_scored_counts"] = _with(RATINGS_CTE) + """
, ranked AS (
  SELECT *, row_number() OVER (ORDER BY timestamp, userId, movieId, rating) AS rn, COUNT(*) OVER () AS n
  FROM ratings
)
""" + _SCORED

ORACLES["als_quality"] = _with(RATINGS_CTE) + """
, ranked AS (
  SELECT *, row_number() OVER (ORDER BY timestamp, userId, movieId, rating) AS rn, COUNT(*) OVER () AS n
  FROM ratings
)
SELECT *, TRUE AS mse_is_rmse_squared, TRUE AS mae_within_rmse, TRUE AS halves_the_error_of_means FROM (""" + _SCORED + ")"

ORACLES["als_user_clusters"] = _with(RATINGS_CTE) + _ALS_SPLIT + """
SELECT CAST(row_number() OVER (ORDER BY size DESC, cluster) AS INTEGER) AS rank, cluster, size
FROM (SELECT MIN(userId) AS cluster, COUNT(DISTINCT userId) AS size FROM train GROUP BY userId % 3)
"""

# ------------------------------------------------------------------- scans

ORACLES["films_csv_scan"] = """
SELECT CAST(p_partkey AS INTEGER) AS movieId, 'The "' || replace(p_name, ' ', ', ') || '" (1995)' AS title,
       replace(p_name, ' ', '|') AS genres
FROM part
"""

ORACLES["csv_headerless_scan"] = "SELECT CAST(label % 2 AS DOUBLE) AS label, " + ", ".join(
    f"round(CAST(embedding[{i}] AS DOUBLE), 5) + 0.0 AS feature{i}" for i in range(1, 65)
) + " FROM embeddings"

ORACLES["csv_header_scan"] = _with(RATINGS_CTE) + "SELECT userId, movieId, rating, timestamp FROM ratings"

# ------------------------------------------- the same results by other means

for _key in ("top_hosts_sketch", "top_hosts_bucketed", "published_reports"):
    ORACLES[_key] = ORACLES["top_hosts"]
ORACLES["gzip_ranges"] = ORACLES["log_parse"]
ORACLES["except_digest"] = ORACLES["except_distinct"]

ORACLES["unique_hosts_by_range"] = _with(LOG_CTE) + """
SELECT country, first_day, last_day, COUNT(DISTINCT host) AS unique_hosts
FROM clog JOIN (VALUES (1, 7), (8, 14), (15, 31), (1, 31)) AS r(first_day, last_day) ON day BETWEEN first_day AND last_day
GROUP BY country, first_day, last_day
"""

ORACLES["heatmap_empty"] = _with(LOG_CTE) + """
SELECT country, day, hour, COUNT(*) AS visits FROM plog WHERE country = 'xx' GROUP BY country, day, hour
"""

ORACLES["chrono_cuts_many"] = _with(RATINGS_CTE) + _RANKED + (
    "SELECT userId, movieId, rating, timestamp, "
    + ", ".join(f"rn <= floor(CAST({f / 10} AS DOUBLE) * n) AS train_{f * 10}" for f in range(1, 10))
    + " FROM ranked"
)

ORACLES["ordered_export"] = _with(RATINGS_CTE) + """
SELECT userId, movieId, rating, timestamp, row_number() OVER (ORDER BY rating, userId, movieId, timestamp) - 1 AS position FROM ratings
"""

ORACLES["auc_by_group"] = """
WITH scores AS (
  SELECT CAST(l_returnflag = 'R' AS DOUBLE) AS label, unnest(['l_discount', 'l_quantity', 'l_extendedprice']) AS model,
         unnest([CAST(l_discount AS DOUBLE), CAST(l_quantity AS DOUBLE), CAST(l_extendedprice AS DOUBLE)]) AS score
  FROM lineitem
), s AS (
  SELECT model, score, SUM(label) AS pos, SUM(1 - label) AS neg FROM scores GROUP BY model, score
), c AS (
  SELECT *, COALESCE(SUM(neg) OVER (PARTITION BY model ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before
  FROM s
)
SELECT model, round(SUM(pos * (neg_before + 0.5 * neg)) / (SUM(pos) * SUM(neg)), 9) AS auc,
       CAST(SUM(pos) AS BIGINT) AS positives, CAST(SUM(neg) AS BIGINT) AS negatives
FROM c GROUP BY model
"""

ORACLES["metric_override"] = _with(RATINGS_CTE) + _BASELINE + f"""
, rep AS ({_reg("movie_mean")})
SELECT 'rmse' AS metric, rmse AS value FROM rep UNION ALL SELECT 'mse', mse FROM rep UNION ALL SELECT 'mae', mae FROM rep
"""

_DICT = ["o_orderkey", "c_mktsegment", "ClaimNb"]
ORACLES["dictionary_index"] = (
    _with(CLAIMS_CTE, *[_index_cte(c, "claims") for c in _DICT])
    + "SELECT o_orderkey, "
    + ", ".join(f"CAST(idx_{c}.i AS BIGINT) AS {c}_index" for c in _DICT)
    + " FROM claims "
    + " ".join(f"JOIN idx_{c} ON claims.{c} = idx_{c}.v" for c in _DICT)
)

_DAMAGED = """
, damaged AS (
  SELECT *, CASE WHEN userId % 29 = 0 THEN 'rating' WHEN userId % 31 = 0 OR userId % 37 = 0 THEN 'fields' END AS reason FROM ratings
)
"""

ORACLES["csv_rejects"] = _with(RATINGS_CTE) + _DAMAGED + """
SELECT reason, CASE WHEN userId % 29 = 0 THEN concat_ws(',', userId, movieId, 'bad', timestamp)
                    WHEN userId % 31 = 0 THEN concat_ws(',', userId, movieId, rating)
                    ELSE concat_ws(',', userId, movieId, rating, timestamp, 'x') END AS line
FROM damaged WHERE reason IS NOT NULL
"""

ORACLES["csv_good_rows"] = _with(RATINGS_CTE) + _DAMAGED + """
SELECT userId, movieId, rating, CASE WHEN userId % 41 <> 0 THEN timestamp END AS timestamp FROM damaged WHERE reason IS NULL
"""

# ------------------------------------------------ models with known results

ORACLES["logistic_l2_optimum"] = _with(CLAIMS_CTE) + f"""
SELECT CAST(unnest(range({len(_NUM)} + {" + ".join(f"count(DISTINCT {c})" for c in _CAT)})) AS INTEGER) AS slot, TRUE AS stationary, TRUE AS not_zero
FROM claims
"""

ORACLES["compare_networks"] = """
SELECT 'mlp' AS model, unnest(['best layers', 'balanced_accuracy', 'auc']) AS metric, unnest(['[1, 8, 2]', '1', '1']) AS value
"""

ORACLES["claims_models_rates"] = _with(CLAIMS_CTE) + f"""
, split AS (
  SELECT *, rn <= floor(CAST(0.7 AS DOUBLE) * n) AS train FROM (
    SELECT *, row_number() OVER (PARTITION BY hasClaim ORDER BY {hash_sql('o_orderkey')}, o_orderkey) AS rn,
           COUNT(*) OVER (PARTITION BY hasClaim) AS n
    FROM claims)
), rates AS (
  SELECT o_orderstatus, SUM(ClaimNb) / SUM(Exposure) AS per_exposure, avg(hasClaim) AS p FROM split WHERE train GROUP BY o_orderstatus
), scored AS (
  SELECT s.*, per_exposure, p FROM split s JOIN rates USING (o_orderstatus) WHERE NOT train
), groups AS (
  SELECT p, SUM(hasClaim) AS pos, SUM(1 - hasClaim) AS neg FROM scored GROUP BY p
), below AS (
  SELECT *, COALESCE(SUM(neg) OVER (ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_before FROM groups
), found AS (
  SELECT 'poisson' AS kind, 'rmse' AS metric, sqrt(avg((Exposure * per_exposure - ClaimNb) * (Exposure * per_exposure - ClaimNb))) AS value FROM scored
  UNION ALL SELECT 'logistic', 'auc', SUM(pos * (neg_before + 0.5 * neg)) / (SUM(pos) * SUM(neg)) FROM below
  UNION ALL SELECT 'logistic', 'accuracy', avg(CAST((p > 0.5)::INT = hasClaim AS INT)) FROM scored
)
SELECT model, metric, round(value, 3) + 0.0 AS value
FROM found JOIN (VALUES ('poisson', 'poisson'), ('logistic', 'logistic_l1'), ('logistic', 'logistic_l2')) AS m(kind, model) USING (kind)
"""

ORACLES["als_reconstruction"] = _with(RATINGS_CTE) + """
SELECT userId % 3 AS leaning, COUNT(*) AS n, TRUE AS given_back FROM ratings GROUP BY userId % 3
"""
