"""DuckDB statements that state each registered query's result independently.

They follow the definitions literally (windows, ``mode`` by counting, all-pairs
distances), so agreement also checks the reformulations used on Spark.
"""

from __future__ import annotations

CANONICAL = """
canonical AS (
  SELECT e.event_id, e.ts AS event_time,
         CASE e.event_type WHEN 'click' THEN 'cart' ELSE e.event_type END AS event_type,
         k AS product_id, k % 10 AS category_id,
         CASE WHEN k % 7 = 0 THEN NULL ELSE p_type END AS category_code,
         CASE WHEN k % 10 = 0 THEN NULL ELSE p_brand END AS brand,
         value AS price, user_id,
         CAST(user_id AS VARCHAR) || '-' || strftime(ts, '%Y-%m-%d') AS user_session
  FROM (SELECT *, CAST(regexp_extract(props, '[0-9]+') AS BIGINT) AS k FROM events) e
  LEFT JOIN part ON p_partkey = k
)"""

SPARSE = (
    CANONICAL
    + """,
sparse AS (
  SELECT * REPLACE (
    CASE WHEN user_id % 10 = 1 AND event_type = 'view' THEN 'cart' WHEN user_id % 10 IN (2, 5, 6) AND event_type = 'purchase' THEN 'view'
         WHEN user_id % 10 = 3 AND event_type = 'cart' THEN 'view' ELSE event_type END AS event_type,
    CASE WHEN user_id % 10 = 8 THEN date_trunc('hour', event_time) ELSE event_time END AS event_time,
    CASE WHEN user_id % 10 = 4 THEN 1000000000 + event_id ELSE user_id END AS user_id)
  FROM canonical
)"""
)

EVENTS = {"canonical": CANONICAL, "sparse": SPARSE}


def _customers(source: str) -> str:
    """CTEs ending in ``cust``: one row per customer, every column unrounded."""
    return (
        EVENTS[source]
        + f""",
ev AS (SELECT * FROM {source} WHERE user_id IS NOT NULL),
base AS (
  SELECT user_id, count(*) AS total_events,
    count(*) FILTER (event_type = 'view') AS view_count,
    count(*) FILTER (event_type = 'cart') AS cart_count,
    count(*) FILTER (event_type = 'purchase') AS purchase_count,
    coalesce(sum(price) FILTER (event_type = 'purchase'), 0.0) AS total_spending,
    CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN avg(price) FILTER (event_type = 'purchase') ELSE 0.0 END AS avg_order_value,
    CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN max(price) FILTER (event_type = 'purchase') ELSE 0.0 END AS max_order_value,
    CASE WHEN count(*) FILTER (event_type = 'purchase') > 0 THEN min(price) FILTER (event_type = 'purchase') ELSE 0.0 END AS min_order_value,
    CASE WHEN count(*) FILTER (event_type = 'view') > 0 THEN avg(price) FILTER (event_type = 'view') ELSE 0.0 END AS avg_price_viewed,
    CASE WHEN count(*) FILTER (event_type = 'view') > 0 THEN stddev_samp(price) FILTER (event_type = 'view') ELSE 0.0 END AS price_std,
    CASE WHEN count(*) FILTER (event_type = 'view') > 0 THEN (max(price) FILTER (event_type = 'view')) - (min(price) FILTER (event_type = 'view')) ELSE 0.0 END AS price_range,
    count(DISTINCT product_id) AS unique_products_viewed,
    count(DISTINCT product_id) FILTER (event_type = 'purchase') AS unique_products_purchased,
    count(DISTINCT category_id) AS unique_categories,
    count(DISTINCT brand) AS unique_brands,
    count(DISTINCT user_session) AS unique_sessions,
    min(event_time) AS t0, max(event_time) AS t1,
    date_diff('microsecond', min(event_time), max(event_time)) / 3600000000.0 AS time_span_hours
  FROM ev GROUP BY user_id
),
gaps AS (
  SELECT user_id, avg(gap) FILTER (gap > 0) AS mean_gap FROM (
    SELECT user_id, date_diff('microsecond', lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time), event_time) / 3600000000.0 AS gap FROM ev
  ) GROUP BY user_id
),
hours AS (
  SELECT user_id, h FROM (
    SELECT user_id, hour(event_time) AS h, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, hour(event_time)) AS rn
    FROM ev WHERE event_time IS NOT NULL GROUP BY user_id, hour(event_time)
  ) WHERE rn = 1
),
cats AS (SELECT user_id, category_id, count(*) AS n FROM ev WHERE category_id IS NOT NULL GROUP BY ALL),
topcat AS (
  SELECT user_id, category_id FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, category_id) AS rn FROM cats
  ) WHERE rn = 1
),
hhi AS (
  SELECT user_id, CAST(sum(n * n) AS DOUBLE) / (any_value(total_events) * any_value(total_events)) AS hhi
  FROM cats JOIN base USING (user_id) GROUP BY user_id
),
sess AS (
  SELECT user_id, avg(d) AS avg_d, max(d) AS max_d FROM (
    SELECT user_id, user_session, date_diff('microsecond', min(event_time), max(event_time)) / 3600000000.0 AS d
    FROM ev WHERE user_session IS NOT NULL GROUP BY ALL HAVING count(*) > 1
  ) GROUP BY user_id
),
cust AS (
  SELECT b.user_id, total_events, view_count, cart_count, purchase_count, total_spending,
    avg_order_value, max_order_value, min_order_value, avg_price_viewed,
    unique_products_viewed, unique_products_purchased, unique_categories, unique_brands, unique_sessions,
    time_span_hours, coalesce(mean_gap, 0.0) AS avg_time_between_events_hours,
    CAST(h AS INTEGER) AS peak_activity_hour,
    CASE WHEN view_count > 0 THEN purchase_count / view_count ELSE 0.0 END AS purchase_conversion_rate,
    CASE WHEN view_count > 0 THEN cart_count / view_count ELSE 0.0 END AS cart_conversion_rate,
    CASE WHEN cart_count > 0 THEN 1 - purchase_count / cart_count ELSE 0.0 END AS cart_abandonment_rate,
    CASE WHEN purchase_count > 0 THEN view_count / purchase_count WHEN view_count > 0 THEN CAST('inf' AS DOUBLE) ELSE 0.0 END AS browse_to_buy_ratio,
    unique_products_viewed / total_events AS product_diversity,
    unique_categories / total_events AS category_diversity,
    unique_brands / total_events AS brand_diversity,
    coalesce(hhi, 0.0) AS category_concentration, topcat.category_id AS top_category_id,
    CASE WHEN unique_sessions > 0 THEN total_events / unique_sessions ELSE 0.0 END AS avg_events_per_session,
    coalesce(avg_d, 0.0) AS avg_session_duration_hours, coalesce(max_d, 0.0) AS max_session_duration_hours,
    price_std, price_range,
    CAST(floor((epoch_us(t0) - epoch_us((SELECT min(t0) FROM base))) / 86400000000.0) AS BIGINT) AS days_since_first_event,
    CAST(floor((epoch_us(t1) - epoch_us((SELECT min(t0) FROM base))) / 86400000000.0) AS BIGINT) AS days_since_last_event
  FROM base b LEFT JOIN gaps USING (user_id) LEFT JOIN hours USING (user_id) LEFT JOIN topcat USING (user_id)
  LEFT JOIN hhi USING (user_id) LEFT JOIN sess USING (user_id)
)"""
    )


CUSTOMERS = {source: _customers(source) for source in EVENTS}


def _rfm(customers: str, key: str = "user_id", source: str = "cust") -> str:
    edge = "list_sort(list_distinct(quantile_cont({0}, [0.0, 0.2, 0.4, 0.6, 0.8, 1.0])))"
    score = "CASE WHEN len({1}) < 2 THEN NULL ELSE 1 + len(list_filter({1}[2:len({1}) - 1], lambda e: e < {0})) END"
    return (
        customers
        + f""",
rfm0 AS (SELECT *, days_since_last_event AS recency, purchase_count AS frequency, total_events AS frequency_events, total_spending AS monetary FROM {source}),
edges AS (SELECT {edge.format('recency')} AS re, {edge.format('frequency')} AS fe, {edge.format('monetary')} AS me FROM rfm0),
rfm AS (
  SELECT rfm0.*, CAST(6 - {score.format('recency', 're')} AS INTEGER) AS recency_score,
    CAST({score.format('frequency', 'fe')} AS INTEGER) AS frequency_score,
    CAST({score.format('monetary', 'me')} AS INTEGER) AS monetary_score
  FROM rfm0, edges
)"""
    )


RFM = {source: _rfm(CUSTOMERS[source]) for source in EVENTS}


def r6(expr: str, name: str | None = None) -> str:
    """Rounded double; infinities become 1e300 of their sign, NaN NULL and negative zero zero."""
    value = f"CAST({expr} AS DOUBLE)"
    return (
        f"CASE WHEN isfinite({value}) THEN round({value}, 6) + 0.0 WHEN {value} = CAST('inf' AS DOUBLE) THEN 1e300 "
        f"WHEN {value} = CAST('-inf' AS DOUBLE) THEN -1e300 END AS {name or expr}"
    )


ENGINEERED = {
    source: RFM[source]
    + """,
ranked AS (
  SELECT user_id, (rank() OVER (ORDER BY avg_price_viewed) + (count(*) OVER (PARTITION BY avg_price_viewed) - 1) / 2.0)
    / count(*) OVER () AS pct FROM rfm WHERE avg_price_viewed IS NOT NULL
),
eng AS (
  SELECT rfm.*,
    total_events / (time_span_hours / 24 + 1) AS engagement_intensity,
    purchase_count / (time_span_hours / 24 + 1) AS purchase_frequency,
    purchase_count * 0.6 + purchase_count / (time_span_hours / 24 + 1) * 0.4 AS loyalty_score,
    total_spending * 0.7 + purchase_count * 0.3 AS value_score,
    CASE WHEN total_events <= 5 THEN 'Low' WHEN total_events <= 20 THEN 'Medium' WHEN total_events <= 100 THEN 'High' ELSE 'Very High' END AS activity_level,
    CASE WHEN total_spending <= 0 THEN NULL WHEN total_spending <= 0.01 THEN 'No Purchase' WHEN total_spending <= 100 THEN 'Low'
         WHEN total_spending <= 500 THEN 'Medium' ELSE 'High' END AS spending_level,
    CAST(peak_activity_hour >= 6 AND peak_activity_hour < 12 AS INTEGER) AS is_morning_user,
    CAST(peak_activity_hour >= 12 AND peak_activity_hour < 18 AS INTEGER) AS is_afternoon_user,
    CAST(peak_activity_hour >= 18 OR peak_activity_hour < 6 AS INTEGER) AS is_evening_user,
    CASE WHEN avg_session_duration_hours <= 0 THEN NULL WHEN avg_session_duration_hours <= 1 THEN 'Short'
         WHEN avg_session_duration_hours <= 3 THEN 'Medium' ELSE 'Long' END AS session_length_category,
    (product_diversity + category_diversity) / 2 AS exploration_score,
    1 - (product_diversity + category_diversity) / 2 AS focus_score,
    CAST(unique_categories > 3 AS INTEGER) AS is_multi_category_shopper,
    unique_categories AS category_breadth,
    1 - unique_brands / (total_events + 1) AS brand_loyalty_score,
    price_std / (avg_price_viewed + 1) AS price_sensitivity,
    pct AS price_preference_percentile,
    CAST(coalesce(pct > 0.75, false) AS INTEGER) AS is_premium_shopper,
    CAST(coalesce(pct < 0.25, false) AS INTEGER) AS is_budget_shopper,
    price_range AS price_range_tolerance
  FROM rfm LEFT JOIN ranked USING (user_id)
)"""
    for source in EVENTS
}

INTEGER_COLUMNS = {
    "user_id", "total_events", "view_count", "cart_count", "purchase_count", "unique_products_viewed",
    "unique_products_purchased", "unique_categories", "unique_brands", "unique_sessions", "peak_activity_hour",
    "top_category_id", "days_since_first_event", "days_since_last_event", "recency", "frequency", "frequency_events",
    "recency_score", "frequency_score", "monetary_score", "is_morning_user", "is_afternoon_user", "is_evening_user",
    "is_multi_category_shopper", "category_breadth", "is_premium_shopper", "is_budget_shopper", "activity_level",
    "spending_level", "session_length_category",
}


def pick(cols: list[str]) -> str:
    return ", ".join(c if c in INTEGER_COLUMNS else r6(c) for c in cols)


def from_table(ctes: str, table: str, cols: list[str]) -> str:
    return f"WITH {ctes} SELECT {pick(['user_id', *cols])} FROM {table}"


# --- preprocessing over the customer columns ---------------------------------


def _filled(cols: list[str], source: str, strategy: str = "median") -> str:
    """CTEs ending in ``filled``: finite values, NULLs replaced by the column's median, mean or mode, or their rows dropped."""
    finite = ", ".join(f"CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END AS {c}" for c in cols)
    mode = "(SELECT {c} FROM finite_x WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"
    fill = {"median": "median({c})", "mean": "avg({c})", "mode": f"any_value({mode})", "drop": "max(CAST(NULL AS DOUBLE))"}[strategy]
    medians = ", ".join(f"{fill.format(c=c)} AS md_{c}" for c in cols)
    whole = f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in cols)}" if strategy == "drop" else ""
    filled = ", ".join(f"coalesce({c}, md_{c}) AS {c}" for c in cols)
    return (
        CUSTOMERS[source]
        + f""",
finite_x AS (SELECT user_id, {finite} FROM cust),
medians AS (SELECT {medians} FROM finite_x),
filled AS (SELECT user_id, {filled} FROM finite_x, medians {whole})"""
    )


def _capped(cols: list[str], source: str) -> str:
    q = ", ".join(f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}" for c in cols)
    clip = ", ".join(
        f"CASE WHEN q3_{c} > q1_{c} THEN greatest(least({c}, q3_{c} + 1.5 * (q3_{c} - q1_{c})), q1_{c} - 1.5 * (q3_{c} - q1_{c})) ELSE {c} END AS {c}"
        for c in cols
    )
    p = ", ".join(f"quantile_cont({c}, 0.05) AS lo_{c}, quantile_cont({c}, 0.95) AS hi_{c}" for c in cols)
    cap = ", ".join(
        f"CASE WHEN q3_{c} > q1_{c} THEN greatest(least({c}, hi_{c}), lo_{c}) ELSE {c} END AS {c}" for c in cols
    )
    return (
        _filled(cols, source)
        + f""",
quartiles AS (SELECT {q} FROM filled),
clipped AS (SELECT user_id, {clip} FROM filled, quartiles),
tails AS (SELECT {p} FROM clipped),
capped AS (SELECT user_id, {cap} FROM clipped, quartiles, tails)"""
    )


def doubles(cols: list[str], table: str) -> str:
    return f"SELECT user_id, {', '.join(r6(c) for c in cols)} FROM {table}"


def finite_doubles(cols: list[str], table: str) -> str:
    """As ``doubles``, with infinities as NULL."""
    finite = (r6(f"(CASE WHEN isfinite(CAST({c} AS DOUBLE)) THEN CAST({c} AS DOUBLE) END)", c) for c in cols)
    return f"SELECT user_id, {', '.join(finite)} FROM {table}"


def imputed(cols: list[str], source: str, strategy: str = "median") -> str:
    return f"WITH {_filled(cols, source, strategy)} {doubles(cols, 'filled')}"


def capped(cols: list[str], source: str) -> str:
    return f"WITH {_capped(cols, source)} {doubles(cols, 'capped')}"


def scaled_ctes(cols: list[str], source: str, method: str) -> str:
    """CTEs ending in ``scaled``, unrounded."""
    if method == "robust":
        center, spread = "median({c})", "quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)"
    else:
        center, spread = "avg({c})", "stddev_pop({c})"
    stats = ", ".join(f"{center.format(c=c)} AS ce_{c}, {spread.format(c=c)} AS sp_{c}" for c in cols)
    out = ", ".join(f"({c} - ce_{c}) / (CASE WHEN sp_{c} > 1e-12 THEN sp_{c} ELSE 1.0 END) AS {c}" for c in cols)
    return f"{_capped(cols, source)}, stats AS (SELECT {stats} FROM capped), scaled AS (SELECT user_id, {out} FROM capped, stats)"


def scaled(cols: list[str], source: str, method: str) -> str:
    return f"WITH {scaled_ctes(cols, source, method)} {doubles(cols, 'scaled')}"


def preprocessed(cols: list[str], source: str) -> str:
    """Robustly scaled features that are not dropped for correlation or variance, in long form."""
    variance = " UNION ALL ".join(f"SELECT '{c}' AS feature, var_pop({c}) AS v FROM capped" for c in cols)
    rows = " UNION ALL ".join(f"SELECT user_id, '{c}' AS feature, {r6(c, 'scaled')} FROM scaled" for c in cols)
    wide = ", ".join(f"corr({a}, {b}) AS r_{i}_{j}" for i, a in enumerate(cols) for j, b in enumerate(cols[:i]))
    pairs = ", ".join(f"('{a}', '{b}', r_{i}_{j})" for i, a in enumerate(cols) for j, b in enumerate(cols[:i]))
    return f"""WITH {scaled_ctes(cols, source, 'robust')}, corrs AS (SELECT {wide} FROM capped),
      pairs AS (SELECT t[1] AS feature, t[3] AS r FROM (SELECT unnest([{pairs}]) AS t FROM corrs)),
      vars AS ({variance}), long AS ({rows})
    SELECT long.* FROM long JOIN vars USING (feature)
    WHERE v > 0.01 AND feature NOT IN (SELECT feature FROM pairs WHERE isfinite(r) AND abs(r) > 0.95)"""


def variances(cols: list[str], source: str) -> str:
    parts = [f"SELECT '{c}' AS feature, var_pop({c}) AS v FROM capped" for c in cols]
    return (
        f"WITH {_capped(cols, source)}, vars AS ({' UNION ALL '.join(parts)}) "
        f"SELECT feature, {r6('v', 'variance')}, v > 0.01 AS kept FROM vars"
    )


def correlations(cols: list[str], source: str) -> str:
    """CTEs ending in ``pairs(feature_a, feature_b, r)`` with feature_b earlier."""
    wide = ", ".join(f"corr({a}, {b}) AS r_{i}_{j}" for i, a in enumerate(cols) for j, b in enumerate(cols[:i]))
    rows = ", ".join(
        f"('{a}', '{b}', r_{i}_{j})" for i, a in enumerate(cols) for j, b in enumerate(cols[:i])
    )
    long = f"SELECT unnest([{rows}]) AS t FROM corrs"
    return (
        f"{_capped(cols, source)}, corrs AS (SELECT {wide} FROM capped), "
        f"pairs AS (SELECT t[1] AS feature_a, t[2] AS feature_b, t[3] AS r FROM ({long}))"
    )


def correlation_pairs(cols: list[str], source: str) -> str:
    return f"WITH {correlations(cols, source)} SELECT feature_a, feature_b, {r6('r')} FROM pairs"


def correlation_drops(cols: list[str], source: str) -> str:
    return (
        f"WITH {correlations(cols, source)} SELECT DISTINCT feature_a AS feature FROM pairs "
        "WHERE isfinite(r) AND abs(r) > 0.95"
    )


# --- given-label metrics over the embeddings ---------------------------------

VECTORS = "vecs AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, label AS cluster FROM embeddings)"


def labelled(label: str) -> str:
    return f"vecs AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, CAST({label} AS INTEGER) AS cluster FROM embeddings)"


SILHOUETTE = """
dist AS (
  SELECT a.id, a.cluster AS own, b.cluster, sum(list_distance(a.e, b.e)) AS total, count(*) AS n
  FROM vecs a, vecs b GROUP BY 1, 2, 3
),
ab AS (
  SELECT id, max(n) FILTER (own = cluster) AS size,
    max(CASE WHEN own = cluster AND n > 1 THEN total / (n - 1) END) AS a, min(total / n) FILTER (own <> cluster) AS b
  FROM dist GROUP BY id
),
sil AS (SELECT avg(CASE WHEN size > 1 THEN (b - a) / greatest(a, b) ELSE 0.0 END) AS s FROM ab)"""

CENTROIDS = """
parts AS (SELECT id, cluster, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM vecs),
cents AS (
  SELECT cluster, list(m ORDER BY pos) AS c FROM (SELECT cluster, pos, avg(x) AS m FROM parts GROUP BY 1, 2) GROUP BY 1
),
overall AS (SELECT list(m ORDER BY pos) AS c FROM (SELECT pos, avg(x) AS m FROM parts GROUP BY 1)),
spread AS (
  SELECT cluster, any_value(c) AS c, count(*) AS n, avg(list_distance(e, c)) AS s, sum(list_distance(e, c) ** 2) AS ss
  FROM vecs JOIN cents USING (cluster) GROUP BY 1
)"""

DAVIES_BOULDIN = """
db AS (
  SELECT avg(worst) AS v FROM (
    SELECT a.cluster, max((a.s + b.s) / list_distance(a.c, b.c)) AS worst FROM spread a JOIN spread b ON a.cluster <> b.cluster GROUP BY 1
  )
)"""

CALINSKI = """
ch AS (
  SELECT (sum(n * list_distance(spread.c, overall.c) ** 2) / (count(*) - 1)) / (sum(ss) / (sum(n) - count(*))) AS v FROM spread, overall
)"""


def dbscan(points: str, eps: float, min_samples: int) -> str:
    """Labels of the CTE ``pts(id, e)``, by reachability over core pairs."""
    return f"""WITH RECURSIVE {points},
    near AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM pts a, pts b WHERE list_distance(a.e, b.e) <= {eps}),
    core AS MATERIALIZED (SELECT a AS id FROM near GROUP BY 1 HAVING count(*) >= {min_samples}),
    links AS MATERIALIZED (SELECT a, b FROM near SEMI JOIN core ca ON a = ca.id SEMI JOIN core cb ON b = cb.id),
    reach AS (SELECT id, id AS seed FROM core UNION SELECT links.b, reach.seed FROM reach JOIN links ON links.a = reach.id),
    comp AS (SELECT id, min(seed) AS root FROM reach GROUP BY 1),
    num AS (SELECT root, dense_rank() OVER (ORDER BY root) - 1 AS cluster FROM (SELECT DISTINCT root FROM comp)),
    cored AS (SELECT comp.id, num.cluster FROM comp JOIN num USING (root)),
    border AS (SELECT near.a AS id, min(cored.cluster) AS cluster FROM near JOIN cored ON near.b = cored.id
               WHERE near.a NOT IN (SELECT id FROM core) GROUP BY 1)
    SELECT pts.id, CAST(coalesce(cored.cluster, border.cluster, -1) AS INTEGER) AS cluster
    FROM pts LEFT JOIN cored USING (id) LEFT JOIN border USING (id)"""


def three_lloyd_steps() -> str:
    """Sizes and total cost after three Lloyd steps from the vectors 0, 1 and 2."""
    steps = ["vecs AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)"]
    steps.append("c0 AS (SELECT CAST(id AS INTEGER) AS cluster, e AS c FROM vecs WHERE id < 3)")
    for i in range(4):
        near = f"SELECT id, any_value(e) AS e, arg_min(cluster, list_distance(e, c)) AS cluster, min(list_distance(e, c)) AS d FROM vecs, c{i} GROUP BY id"
        steps.append(f"n{i} AS ({near})")
        long = f"SELECT cluster, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM n{i}"
        means = f"SELECT cluster, pos, avg(x) AS m FROM ({long}) GROUP BY 1, 2"
        steps.append(f"c{i + 1} AS (SELECT cluster, list(m ORDER BY pos) AS c FROM ({means}) GROUP BY 1)")
    body = ",\n".join(steps)
    return f"""WITH {body}
    SELECT CAST(cluster AS INTEGER) AS cluster, count(*) AS n_rows, {r6('(SELECT sum(d * d) FROM n3)', 'cost')} FROM n3 GROUP BY 1"""


def picked_k(inertia_ctes: str) -> str:
    """The K that each rule picks from the scores of the labellings ``id % k``."""
    scores = []
    for k in range(2, 11):
        square = SILHOUETTE.replace("sum(list_distance(a.e, b.e))", "sum(list_distance(a.e, b.e) ** 2)")
        for name in ("dist", "ab", "sil"):
            square = square.replace(f"{name} AS", f"{name}2 AS").replace(f"FROM {name}", f"FROM {name}2")
        ctes = ", ".join([labelled(f"vec_id % {k}"), SILHOUETTE, square, CENTROIDS, DAVIES_BOULDIN, CALINSKI])
        scores.append(f"SELECT {k} AS k, * FROM (WITH {ctes} SELECT sil.s AS s, sil2.s AS q, db.v AS d, ch.v AS c FROM sil, sil2, db, ch)")
    return f"""WITH {inertia_ctes}, rated AS ({' UNION ALL '.join(scores)}),
      dr AS (SELECT k, inertia - lead(inertia) OVER (ORDER BY k) AS fall, lead(k) OVER (ORDER BY k) AS next_k FROM scores),
      rt AS (SELECT *, CASE WHEN lead(fall) OVER (ORDER BY k) > 0 THEN fall / lead(fall) OVER (ORDER BY k)
                          WHEN lead(fall) OVER (ORDER BY k) IS NOT NULL THEN 0 END AS rate FROM dr)
    SELECT 'silhouette' AS method, CAST((SELECT k FROM rated ORDER BY s DESC, k LIMIT 1) AS INTEGER) AS k
    UNION ALL SELECT 'silhouette_sq', CAST((SELECT k FROM rated ORDER BY q DESC, k LIMIT 1) AS INTEGER)
    UNION ALL SELECT 'davies_bouldin', CAST((SELECT k FROM rated ORDER BY d, k LIMIT 1) AS INTEGER)
    UNION ALL SELECT 'calinski_harabasz', CAST((SELECT k FROM rated ORDER BY c DESC, k LIMIT 1) AS INTEGER)
    UNION ALL SELECT 'elbow', CAST(coalesce((SELECT next_k FROM rt WHERE rate < 0.5 ORDER BY k LIMIT 1), (SELECT k FROM scores ORDER BY k LIMIT 1 OFFSET 1)) AS INTEGER)"""
