"""Registered queries: every operator over the warehouse tables, with its DuckDB oracle."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from segmentry import settings
from segmentry.functions import finite_or_null
from segmentry.operators import customers, eda, engineer, kselect, metrics, neighbours, preprocess, profiles, quality, rfm, segments
from segmentry.operators.dbscan import dbscan
from segmentry.functions.vectors import squared_distance
from segmentry.operators.kmeans import assign, lloyd
from segmentry.operators.stages import FeaturePreprocessor
from segmentry.plans import oracles
from segmentry.plans import pipeline as job
from segmentry.session import new_folder
from segmentry.sources import coerce_events, exact_sample, row_count, take_rows
from segmentry.sources.warehouse import events_canonical, events_sparse, labelled_vectors, order_customers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
SOURCES = {"canonical": events_canonical, "sparse": events_sparse}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles rounded to six places, infinities as 1e300 of their sign, NaN as NULL, no negative zero."""
    inf = F.lit(float("inf"))
    cols = [
        F.when(F.col(f.name) == inf, 1e300)
        .when(F.col(f.name) == -inf, -1e300)
        .otherwise(F.round(finite_or_null(F.col(f.name)), 6) + F.lit(0.0))
        .alias(f.name)
        if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*cols)


def register(name: str, run: Query, sql: str | None = None) -> None:
    QUERIES[name] = lambda spark, sf_dir: comparable(run(spark, sf_dir))
    if sql is not None:
        ORACLES[name] = sql


# --- quality and description of the log --------------------------------------

register("row_count", lambda s, d: row_count(events_canonical(s, d)), "SELECT count(*) AS row_count FROM events")

register(
    "first_rows",
    lambda s, d: take_rows(events_canonical(s, d), 1000, ["event_time", "event_id"]).select("event_id", "event_time", "user_id"),
    "SELECT event_id, ts AS event_time, user_id FROM events ORDER BY ts, event_id LIMIT 1000",
)
register(
    "sampled_rows",
    lambda s, d: exact_sample(events_canonical(s, d), 0.1, order_key="event_id").select("event_id", "event_time", "user_id"),
    """WITH d AS (SELECT *, CAST('0x' || substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 13) AS BIGINT) AS draw FROM events),
      r AS (SELECT *, row_number() OVER (ORDER BY draw, event_id) AS pos FROM d)
    SELECT event_id, ts AS event_time, user_id FROM r WHERE pos <= (SELECT floor(count(*) * 0.1) FROM events)""",
)
_LOG_COLUMNS = [
    "event_id", "event_time", "event_type", "product_id", "category_id", "category_code", "brand", "price",
    "user_id", "user_session",
]
register(
    "quality_nulls",
    lambda s, d: quality.null_counts(events_canonical(s, d)),
    f"WITH {oracles.CANONICAL} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count FROM canonical" for c in _LOG_COLUMNS
    ),
)


def _with_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log without its row id, so that equal events are duplicates."""
    return events_canonical(spark, sf_dir).select("event_type", "product_id", "user_id", "price", "event_time").withColumns(
        {"event_time": F.date_trunc("DAY", "event_time"), "price": F.round(F.col("price") / 10) - 1}
    )


register(
    "quality_counts",
    lambda s, d: quality.quality_counts(_with_copies(s, d)),
    f"""WITH {oracles.CANONICAL}, log AS (
      SELECT event_type, product_id, user_id, round(price / 10) - 1 AS price, date_trunc('day', event_time) AS event_time FROM canonical)
    SELECT count(*) AS row_count, count(*) FILTER (price < 0) AS negative_prices,
      count(*) FILTER (event_time IS NULL) AS invalid_timestamps,
      count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM log)) AS duplicate_rows FROM log""",
)


def _as_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as untyped text with junk in it, coerced back."""
    raw = events_canonical(spark, sf_dir)
    junk = F.col("event_id") % 13 == 0
    text = raw.select(
        "event_id",
        F.when(junk, "not a time").otherwise(F.date_format("event_time", "yyyy-MM-dd HH:mm:ss")).alias("event_time"),
        F.col("event_type"),
        F.when(F.col("event_id") % 11 == 0, "x12").otherwise(F.col("product_id").cast("string")).alias("product_id"),
        F.when(F.col("event_id") % 7 == 0, "n/a").otherwise(F.col("price").cast("string")).alias("price"),
    )
    out = coerce_events(text)
    return out.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))


register(
    "coerced_events",
    _as_text,
    f"""WITH {oracles.CANONICAL} SELECT event_id,
      CASE WHEN event_id % 13 = 0 THEN NULL ELSE date_trunc('second', event_time) END AS event_time, event_type,
      CASE WHEN event_id % 11 = 0 THEN NULL ELSE product_id END AS product_id,
      {oracles.r6('(CASE WHEN event_id % 7 = 0 THEN NULL ELSE price END)', 'price')} FROM canonical""",
)
register(
    "event_type_distribution",
    lambda s, d: quality.event_type_distribution(events_canonical(s, d)),
    f"""WITH {oracles.CANONICAL}, c AS (SELECT event_type, count(*) AS n_events FROM canonical WHERE event_type IS NOT NULL GROUP BY 1)
    SELECT event_type, n_events, {oracles.r6('(n_events / (SELECT sum(n_events) FROM c))', 'proportion')} FROM c""",
)
register(
    "funnel",
    lambda s, d: eda.conversion_funnel(events_canonical(s, d)),
    f"""WITH {oracles.CANONICAL}, c AS (SELECT count(*) FILTER (event_type = 'view') AS v, count(*) FILTER (event_type = 'cart') AS c,
      count(*) FILTER (event_type = 'purchase') AS p FROM canonical)
    SELECT {oracles.r6('(c / v * 100)', 'view_to_cart_pct')}, {oracles.r6('(p / c * 100)', 'cart_to_purchase_pct')},
      {oracles.r6('(p / v * 100)', 'view_to_purchase_pct')} FROM c""",
)
register(
    "date_range",
    lambda s, d: eda.date_range(events_canonical(s, d)),
    "SELECT count(*) AS total_events, min(ts) AS first_event, max(ts) AS last_event FROM events",
)
register(
    "hourly_activity",
    lambda s, d: eda.hourly_activity(events_canonical(s, d)),
    """WITH h AS (SELECT CAST(hour(ts) AS INTEGER) AS hour, count(*) AS n_events FROM events WHERE ts IS NOT NULL GROUP BY 1)
    SELECT hour, n_events, hour = (SELECT hour FROM h ORDER BY n_events DESC, hour LIMIT 1) AS is_peak FROM h""",
)
register(
    "weekday_activity",
    lambda s, d: eda.weekday_activity(events_canonical(s, d)),
    "SELECT dayname(ts) AS day_of_week, count(*) AS n_events FROM events WHERE ts IS NOT NULL GROUP BY 1",
)
_TYPES = ["cart", "error", "purchase", "signup", "view"]
register(
    "hour_by_type",
    lambda s, d: eda.events_by_hour_and_type(events_canonical(s, d), _TYPES),
    f"WITH {oracles.CANONICAL} SELECT CAST(hour(event_time) AS INTEGER) AS hour, "
    + ", ".join(f"count(*) FILTER (event_type = '{t}') AS {t}" for t in _TYPES)
    + " FROM canonical WHERE event_time IS NOT NULL GROUP BY 1",
)
register(
    "distinct_entities",
    lambda s, d: eda.distinct_entities(events_canonical(s, d)),
    f"""WITH {oracles.CANONICAL} SELECT count(DISTINCT user_id) AS unique_users, count(DISTINCT product_id) AS unique_products,
      count(DISTINCT category_id) AS unique_categories, count(DISTINCT user_session) AS unique_sessions FROM canonical""",
)
register(
    "events_per_user_stats",
    lambda s, d: eda.events_per_user_stats(events_canonical(s, d)),
    f"""WITH c AS (SELECT count(*) AS n FROM events WHERE user_id IS NOT NULL GROUP BY user_id)
    SELECT {oracles.r6('avg(n)', 'mean_events')}, {oracles.r6('median(n)', 'median_events')}, max(n) AS max_events FROM c""",
)
register(
    "purchase_stats",
    lambda s, d: eda.purchase_stats(events_canonical(s, d)),
    f"""SELECT count(*) AS total_purchases, {oracles.r6('avg(value)', 'avg_order_value')},
      {oracles.r6('median(value)', 'median_order_value')}, {oracles.r6('sum(value)', 'total_revenue')}
    FROM events WHERE event_type = 'purchase'""",
)


def _histogram_sql(values: str, bins: int) -> str:
    """Equal-width histogram of the CTE ``vals(v)``."""
    index = f"least(CAST(floor((v - lo) / (hi - lo) * {bins}) AS INTEGER), {bins - 1})"
    return f"""WITH {values}, ends AS (SELECT min(v) AS lo, max(v) AS hi FROM vals),
      filled AS (SELECT {index} AS bin, count(*) AS n FROM vals, ends WHERE v IS NOT NULL GROUP BY 1)
    SELECT CAST(b AS INTEGER) AS bin, {oracles.r6(f'(lo + b * (hi - lo) / {bins})', 'bin_low')},
      {oracles.r6(f'(lo + (b + 1) * (hi - lo) / {bins})', 'bin_high')}, coalesce(n, 0) AS n
    FROM range({bins}) AS t(b), ends LEFT JOIN filled ON filled.bin = b"""


register(
    "histogram_events_per_user",
    lambda s, d: eda.histogram(eda.events_per_user(events_canonical(s, d)), "n_events"),
    _histogram_sql("vals AS (SELECT CAST(count(*) AS DOUBLE) AS v FROM events WHERE user_id IS NOT NULL GROUP BY user_id)", 50),
)
register(
    "histogram_purchase_price",
    lambda s, d: eda.histogram(events_canonical(s, d).where("event_type = 'purchase'"), "price"),
    _histogram_sql("vals AS (SELECT value AS v FROM events WHERE event_type = 'purchase')", 50),
)

# --- customer features, on the plain log and on the one with edge cases ------

CUSTOMER_GROUPS = {
    "customer_counts": ["total_events", "view_count", "cart_count", "purchase_count"],
    "customer_spending": ["total_spending", "avg_order_value", "max_order_value", "min_order_value", "avg_price_viewed"],
    "customer_uniques": [
        "unique_products_viewed", "unique_products_purchased", "unique_categories", "unique_brands", "unique_sessions",
    ],
    "customer_temporal": [
        "time_span_hours", "avg_time_between_events_hours", "peak_activity_hour", "days_since_first_event",
        "days_since_last_event",
    ],
    "customer_rates": [
        "purchase_conversion_rate", "cart_conversion_rate", "cart_abandonment_rate", "browse_to_buy_ratio",
        "product_diversity", "category_diversity", "brand_diversity",
    ],
    "category_concentration": ["category_concentration", "top_category_id"],
    "session_metrics": ["avg_events_per_session", "avg_session_duration_hours", "max_session_duration_hours"],
    "price_sensitivity_base": ["price_std", "price_range"],
    "customer_features": customers.CUSTOMER_COLUMNS,
}


def _register_per_source(name: str, run: Callable[[DataFrame], DataFrame], sql: Callable[[str], str] | None) -> None:
    for source, load in SOURCES.items():
        full = name if source == "canonical" else f"{name}_sparse"
        register(full, lambda s, d, load=load: run(load(s, d)), sql(source) if sql else None)


for _name, _cols in CUSTOMER_GROUPS.items():
    _register_per_source(
        _name,
        lambda ev, cols=_cols: customers.customer_features(ev, columns=cols),
        lambda source, cols=_cols: oracles.from_table(oracles.CUSTOMERS[source], "cust", cols),
    )

_RFM_INPUT = ["total_events", "purchase_count", "total_spending", "days_since_last_event"]
_RFM_OUTPUT = [
    "recency", "frequency", "frequency_events", "monetary", "recency_score", "frequency_score", "monetary_score",
]


def _rfm_scores(events: DataFrame) -> DataFrame:
    kept = customers.customer_features(events, columns=_RFM_INPUT).persist()
    return rfm.rfm_scores(kept).select("user_id", *_RFM_OUTPUT)


_register_per_source(
    "rfm_scores", _rfm_scores, lambda source: oracles.from_table(oracles.RFM[source], "rfm", _RFM_OUTPUT)
)
_ORDERS_CTE = """
cust AS (
  SELECT o_custkey AS user_id, count(*) AS total_events, count(*) AS purchase_count, sum(o_totalprice) AS total_spending,
    CAST(floor((epoch_us(max(o_orderdate)) - epoch_us((SELECT min(o_orderdate) FROM orders WHERE o_custkey IS NOT NULL))) / 86400000000.0) AS BIGINT) AS days_since_last_event
  FROM orders WHERE o_custkey IS NOT NULL GROUP BY 1
)"""
register(
    "rfm_scores_orders",
    lambda s, d: rfm.rfm_scores(order_customers(s, d).persist()).select("user_id", *_RFM_OUTPUT),
    oracles.from_table(oracles._rfm(_ORDERS_CTE), "rfm", _RFM_OUTPUT),
)
_TIES_CTE = _ORDERS_CTE + """,
ties AS (SELECT * REPLACE (purchase_count % 3 AS purchase_count, floor(total_spending / 1000000) AS total_spending) FROM cust)"""


def _tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order customers with few different counts and amounts, so that ties lie across the score edges."""
    return order_customers(spark, sf_dir).withColumns(
        {"purchase_count": F.col("purchase_count") % 3, "total_spending": F.floor(F.col("total_spending") / 1000000).cast("double")}
    )


register(
    "rfm_scores_ties",
    lambda s, d: rfm.rfm_scores(_tied(s, d).persist()).select("user_id", *_RFM_OUTPUT),
    oracles.from_table(oracles._rfm(_TIES_CTE, source="ties"), "rfm", _RFM_OUTPUT),
)
register(
    "rfm_recency_as_of",
    lambda s, d: rfm.add_rfm_columns(order_customers(s, d), "as_of").select("user_id", "recency"),
    f"WITH {_ORDERS_CTE} SELECT user_id, (SELECT max(days_since_last_event) FROM cust) - days_since_last_event AS recency FROM cust",
)

# --- derived features ---------------------------------------------------------

ENGINEERED_GROUPS = {
    "behavioral_features": (
        ["total_events", "purchase_count", "total_spending", "time_span_hours"],
        engineer.behavioral_features,
        ["engagement_intensity", "purchase_frequency", "loyalty_score", "value_score", "activity_level", "spending_level"],
    ),
    "temporal_features": (
        ["peak_activity_hour", "avg_session_duration_hours"],
        engineer.temporal_features,
        ["is_morning_user", "is_afternoon_user", "is_evening_user", "session_length_category"],
    ),
    "engagement_features": (
        ["total_events", "product_diversity", "category_diversity", "unique_categories", "unique_brands"],
        engineer.engagement_features,
        ["exploration_score", "focus_score", "is_multi_category_shopper", "category_breadth", "brand_loyalty_score"],
    ),
    "price_features": (
        ["price_std", "price_range", "avg_price_viewed"],
        engineer.price_features,
        [
            "price_sensitivity", "price_preference_percentile", "is_premium_shopper", "is_budget_shopper",
            "price_range_tolerance",
        ],
    ),
}

for _name, (_needs, _derive, _made) in ENGINEERED_GROUPS.items():
    _register_per_source(
        _name,
        lambda ev, needs=_needs, derive=_derive, made=_made: derive(
            customers.customer_features(ev, columns=needs).persist()
        ).select("user_id", *made),
        lambda source, made=_made: oracles.from_table(oracles.ENGINEERED[source], "eng", made),
    )

register(
    "frequency_encoding",
    lambda s, d: engineer.frequency_encode(
        engineer.frequency_encode(
            events_canonical(s, d).select("event_id", "brand", "category_code"), "brand", "brand_frequency_score", "event_id"
        ),
        "category_code",
        "category_code_frequency_score",
        "event_id",
    ).select("event_id", "brand_frequency_score", "category_code_frequency_score"),
    f"""WITH {oracles.CANONICAL} SELECT event_id,
      {oracles.r6('(CASE WHEN brand IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY brand) / (SELECT count(brand) FROM canonical) END)', 'brand_frequency_score')},
      {oracles.r6('(CASE WHEN category_code IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY category_code) / (SELECT count(category_code) FROM canonical) END)', 'category_code_frequency_score')}
    FROM canonical""",
)
register(
    "brand_category_affinity",
    lambda s, d: engineer.pair_affinity(
        events_canonical(s, d).select("event_id", "brand", "category_code"),
        "brand",
        "category_code",
        "brand_category_affinity",
        "event_id",
    ).select("event_id", "brand_category_affinity"),
    f"""WITH {oracles.CANONICAL} SELECT event_id,
      {oracles.r6('(count(*) OVER (PARTITION BY brand, category_code) / (SELECT count(*) FROM canonical))', 'brand_category_affinity')}
    FROM canonical""",
)


def _preferred(events: DataFrame) -> DataFrame:
    kept = customers.customer_features(events, preferred=True, columns=["total_events"]).persist()
    out = engineer.categorical_features(kept)
    scores = ["brand_frequency_score", "category_code_frequency_score", "brand_category_affinity"]
    return out.select("user_id", "most_frequent_brand", "most_frequent_category_code", *scores)


def _preferred_sql(source: str) -> str:
    def modal(col: str) -> str:
        return f"""(SELECT user_id, {col} AS most_frequent_{col} FROM (
          SELECT user_id, {col}, row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, {col}) AS rn
          FROM {source} WHERE user_id IS NOT NULL AND {col} IS NOT NULL GROUP BY user_id, {col}) WHERE rn = 1)"""

    def share(col: str) -> str:
        return f"(CASE WHEN {col} IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY {col}) / (SELECT count({col}) FROM m) END)"

    return f"""WITH {oracles.EVENTS[source]}, m AS (
      SELECT * FROM (SELECT DISTINCT user_id FROM {source} WHERE user_id IS NOT NULL)
      LEFT JOIN {modal('brand')} USING (user_id) LEFT JOIN {modal('category_code')} USING (user_id))
    SELECT user_id, most_frequent_brand, most_frequent_category_code,
      {oracles.r6(share('most_frequent_brand'), 'brand_frequency_score')},
      {oracles.r6(share('most_frequent_category_code'), 'category_code_frequency_score')},
      {oracles.r6('(count(*) OVER (PARTITION BY most_frequent_brand, most_frequent_category_code) / (SELECT count(*) FROM m))', 'brand_category_affinity')}
    FROM m"""


_register_per_source("categorical_features", _preferred, _preferred_sql)


def _engineered(events: DataFrame) -> DataFrame:
    return engineer.engineer_features(rfm.aggregate_events(events))


_ENGINEERED_COLUMNS = [
    *customers.CUSTOMER_COLUMNS, *_RFM_OUTPUT, *[c for _, _, made in ENGINEERED_GROUPS.values() for c in made],
]
_register_per_source(
    "engineered_features",
    lambda ev: _engineered(ev).select("user_id", *_ENGINEERED_COLUMNS),
    lambda source: oracles.from_table(oracles.ENGINEERED[source], "eng", _ENGINEERED_COLUMNS),
)
_SELECTED = [c for c in _ENGINEERED_COLUMNS if not c.endswith(("_level", "_category"))]
_register_per_source(
    "selected_features",
    lambda ev: engineer.select_features(_engineered(ev)).select("user_id", *_SELECTED),
    lambda source: f"WITH {oracles.ENGINEERED[source]} {oracles.finite_doubles(_SELECTED, 'eng')}",
)
_register_per_source(
    "inf_null_rows",
    lambda ev: quality.inf_null_row_counts(customers.customer_features(ev)),
    lambda source: f"""WITH {oracles.CUSTOMERS[source]} SELECT count(*) FILTER (browse_to_buy_ratio = CAST('inf' AS DOUBLE)) AS rows_with_inf,
      count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in customers.CUSTOMER_COLUMNS)}) AS rows_with_null FROM cust""",
)


def _describe_sql(source: str) -> str:
    """Infinities are carried as 1e300; a column that has one has no standard deviation."""

    def big(expr: str, name: str) -> str:
        return f"CASE WHEN {expr} > 1e200 THEN 1e300 ELSE round({expr}, 6) + 0.0 END AS {name}"

    parts = []
    for c in customers.CUSTOMER_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS feature, count(v) AS count, {big('avg(v)', 'mean')}, "
            f"CASE WHEN max(v) < 1e200 THEN round(stddev_samp(CASE WHEN v < 1e200 THEN v END), 6) + 0.0 END AS std, {big('min(v)', 'min')}, "
            f"{big('quantile_cont(v, 0.25)', 'q25')}, {big('median(v)', 'median')}, {big('quantile_cont(v, 0.75)', 'q75')}, {big('max(v)', 'max')} "
            f"FROM (SELECT CASE WHEN {c} > 1e300 THEN 1e300 ELSE CAST({c} AS DOUBLE) END AS v FROM cust)"
        )
    return f"WITH {oracles.CUSTOMERS[source]} " + " UNION ALL ".join(parts)


_register_per_source(
    "describe_customers",
    lambda ev: eda.describe(customers.customer_features(ev).persist(), customers.CUSTOMER_COLUMNS),
    _describe_sql,
)
_register_per_source(
    "histogram_spending",
    lambda ev: eda.histogram(
        customers.customer_features(ev, columns=["total_spending"]).where("total_spending > 0").persist(), "total_spending"
    ),
    lambda source: _histogram_sql(
        oracles.CUSTOMERS[source] + ", vals AS (SELECT total_spending AS v FROM cust WHERE total_spending > 0)", 50
    ),
)
for _col in ("total_events", "purchase_count", "purchase_conversion_rate"):
    _register_per_source(
        f"histogram_{_col}",
        lambda ev, col=_col: eda.histogram(customers.customer_features(ev, columns=[col]).persist(), col),
        lambda source, col=_col: _histogram_sql(oracles.CUSTOMERS[source] + f", vals AS (SELECT CAST({col} AS DOUBLE) AS v FROM cust)", 50),
    )

# --- preprocessing ------------------------------------------------------------

_PRE = customers.CUSTOMER_COLUMNS


def _fitted(events: DataFrame, **options) -> tuple[preprocess.PreprocessModel, DataFrame]:
    df = customers.customer_features(events).persist()
    return preprocess.Preprocessor(**options).fit(df), df


def _keep_all(events: DataFrame, method: str) -> DataFrame:
    """Scaled columns with both column filters switched off."""
    model, df = _fitted(events, scaling_method=method, correlation_threshold=2.0, variance_threshold=-1.0)
    return model.transform(df)


def _stage(events: DataFrame, stage: str, **options) -> DataFrame:
    model, df = _fitted(events, **options)
    return model.stage(df, getattr(model, stage), _PRE)


_register_per_source("imputed_features", lambda ev: _stage(ev, "filled"), lambda source: oracles.imputed(_PRE, source))
for _strategy in ("mean", "mode", "drop"):
    _register_per_source(
        f"imputed_{_strategy}",
        lambda ev, strategy=_strategy: _stage(ev, "filled", missing_value_strategy=strategy),
        lambda source, strategy=_strategy: oracles.imputed(_PRE, source, strategy),
    )
_register_per_source("capped_features", lambda ev: _stage(ev, "capped"), lambda source: oracles.capped(_PRE, source))
for _method in ("robust", "standard"):
    _register_per_source(
        f"{_method}_scaled",
        lambda ev, method=_method: _keep_all(ev, method),
        lambda source, method=_method: oracles.scaled(_PRE, source, method),
    )


def _pairs(events: DataFrame) -> DataFrame:
    model, df = _fitted(events)
    return preprocess.correlation_pairs(model.stage(df, model.capped, _PRE), _PRE)


def _drops(events: DataFrame) -> DataFrame:
    model, _ = _fitted(events)
    return events.sparkSession.createDataFrame([(c,) for c in model.correlated], "feature string")


def _variance(events: DataFrame) -> DataFrame:
    model, df = _fitted(events, correlation_threshold=2.0)
    wide = model.stage(df, model.capped, _PRE).agg(*[F.var_pop(c).alias(c) for c in _PRE])
    long = wide.unpivot([], _PRE, "feature", "variance")
    return long.withColumn("kept", F.col("feature").isin(model.kept))


_register_per_source("correlation_pairs", _pairs, lambda source: oracles.correlation_pairs(_PRE, source))
_register_per_source("correlation_drop_list", _drops, lambda source: oracles.correlation_drops(_PRE, source))
_register_per_source("variance_filter", _variance, lambda source: oracles.variances(_PRE, source))


def _pca(events: DataFrame) -> DataFrame:
    """Explained ratio per component, beside the one recomputed from the projected rows."""
    model, df = _fitted(events, use_pca=True)
    spark, names = events.sparkSession, model.feature_names
    seen = model.transform(df).agg(*[F.var_pop(c).alias(c) for c in names]).unpivot([], names, "component", "variance")
    plain = preprocess.Preprocessor().fit(df).transform(df)
    cols = [c for c in plain.columns if c != "user_id"]
    total = plain.agg(sum((F.var_pop(c) for c in cols), F.lit(0.0)).alias("total"))
    told = spark.createDataFrame(list(zip(names, model.pca_ratio)), "component string, explained_ratio double")
    rows = told.join(seen, "component").withColumn("total", total.scalar())
    return rows.select("component", "explained_ratio", (F.col("variance") / F.col("total")).alias("recomputed_ratio"))


def _preprocessed(events: DataFrame) -> DataFrame:
    """The whole preprocessing, one row per customer and surviving feature."""
    model, df = _fitted(events)
    wide = model.transform(df)
    return wide.unpivot(["user_id"], [c for c in wide.columns if c != "user_id"], "feature", "scaled")


_register_per_source("pca_explained", _pca, None)
_register_per_source("preprocessed_features", _preprocessed, lambda source: oracles.preprocessed(_PRE, source))


def _by_saved_pipeline(events: DataFrame) -> DataFrame:
    """``preprocessed_features`` by a ``PipelineModel`` that was saved and loaded again."""
    df = customers.customer_features(events).persist()
    path = new_folder(events.sparkSession, "pipeline-model")
    Pipeline(stages=[FeaturePreprocessor()]).fit(df).write().save(path)
    model = PipelineModel.load(path)
    names = F.array(*map(F.lit, model.stages[0].learnt.feature_names))
    rows = model.transform(df).select(F.col("id").alias("user_id"), F.posexplode("features").alias("at", "scaled"))
    return rows.select("user_id", F.get(names, F.col("at")).alias("feature"), "scaled")


_register_per_source("preprocessed_by_pipeline", _by_saved_pipeline, lambda source: oracles.preprocessed(_PRE, source))


def _pca_variance(events: DataFrame) -> DataFrame:
    """What all principal components have in common with the columns they are made of: the variance, and right angles."""
    model, df = _fitted(events, use_pca=True, pca_variance_explained=1.0)
    names, loadings = model.feature_names, np.array(model.pca_components)
    wide = model.transform(df)
    pairs = [F.covar_pop(a, b) for i, a in enumerate(names) for b in names[:i]]
    row = wide.agg(
        sum((F.var_pop(c) for c in names), F.lit(0.0)).alias("variance"), F.greatest(F.lit(0.0), F.lit(0.0), *map(F.abs, pairs)).alias("across")
    ).first()
    tilt = float(np.abs(loadings @ loadings.T - np.eye(len(names))).max())
    values = (round(row["variance"], 2), round(row["across"], 6) + 0.0, round(tilt, 6) + 0.0)
    return events.sparkSession.createDataFrame([values], "variance double, covariance double, tilt double")


_register_per_source(
    "pca_variance",
    _pca_variance,
    lambda source: f"""SELECT round(sum(v), 2) AS variance, CAST(0 AS DOUBLE) AS covariance, CAST(0 AS DOUBLE) AS tilt
      FROM (SELECT var_pop(scaled) AS v FROM ({oracles.preprocessed(_PRE, source)}) GROUP BY feature)""",
)
_BOXED = ["total_events", "view_count", "cart_count", "purchase_count", "total_spending"]


def _box_sql(ctes: str, table: str) -> str:
    parts = []
    for c in _BOXED:
        parts.append(
            f"""SELECT '{c}' AS feature, {oracles.r6('q[1]', 'q25')}, {oracles.r6('q[2]', 'median')}, {oracles.r6('q[3]', 'q75')},
          {oracles.r6(f'(SELECT min({c}) FROM {table} WHERE {c} >= q[1] - 1.5 * (q[3] - q[1]))', 'whisker_low')},
          {oracles.r6(f'(SELECT max({c}) FROM {table} WHERE {c} <= q[3] + 1.5 * (q[3] - q[1]))', 'whisker_high')},
          (SELECT count(*) FROM {table} WHERE {c} < q[1] - 1.5 * (q[3] - q[1]) OR {c} > q[3] + 1.5 * (q[3] - q[1])) AS n_outliers
        FROM (SELECT quantile_cont({c}, [0.25, 0.5, 0.75]) AS q FROM {table})"""
        )
    return f"WITH {ctes} " + " UNION ALL ".join(parts)


_register_per_source(
    "box_stats",
    lambda ev: eda.box_stats(customers.customer_features(ev, columns=_BOXED).persist(), _BOXED),
    lambda source: _box_sql(oracles.CUSTOMERS[source], "cust"),
)
_register_per_source(
    "box_stats_scaled",
    lambda ev: eda.box_stats(comparable(_keep_all(ev, "standard")).persist(), _BOXED),
    lambda source: _box_sql(
        f"{oracles.scaled_ctes(_PRE, source, 'standard')}, rounded AS ({oracles.doubles(_BOXED, 'scaled')})", "rounded"
    ),
)

# --- quality of given labels, on the embeddings -------------------------------


def _score(column: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        long = metrics.exploded(metrics.one_labelling(labelled_vectors(spark, sf_dir)))
        return metrics.between_scores(long).select(column)

    return run


register(
    "silhouette_exact",
    lambda s, d: metrics.silhouettes(metrics.one_labelling(labelled_vectors(s, d))).select("silhouette_score"),
    f"WITH {oracles.VECTORS}, {oracles.SILHOUETTE} SELECT {oracles.r6('s', 'silhouette_score')} FROM sil",
)
register(
    "davies_bouldin",
    _score("davies_bouldin"),
    f"WITH {oracles.VECTORS}, {oracles.CENTROIDS}, {oracles.DAVIES_BOULDIN} SELECT {oracles.r6('v', 'davies_bouldin')} FROM db",
)
register(
    "calinski_harabasz",
    _score("calinski_harabasz"),
    f"WITH {oracles.VECTORS}, {oracles.CENTROIDS}, {oracles.CALINSKI} SELECT {oracles.r6('v', 'calinski_harabasz')} FROM ch",
)
register(
    "inertia_given_labels",
    _score("inertia"),
    f"WITH {oracles.VECTORS}, {oracles.CENTROIDS} SELECT {oracles.r6('sum(ss)', 'inertia')} FROM spread",
)


def _three_labellings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled_vectors(spark, sf_dir)
    labels = {"label": F.col("cluster"), "mod3": F.col("id") % 3, "noisy": F.when(F.col("id") % 5 == 0, -1).otherwise(F.col("cluster"))}
    entries = [x for name, c in labels.items() for x in (F.lit(name), c.cast("int"))]
    return rows.select("id", "features", F.create_map(*entries).alias("labels"))


def _quality_sql(name: str, label: str) -> str:
    sizes = "(SELECT count(*) AS n FROM vecs GROUP BY cluster)"
    return f"""SELECT * FROM (WITH {oracles.labelled(label)}, {oracles.SILHOUETTE}, {oracles.CENTROIDS}, {oracles.DAVIES_BOULDIN}, {oracles.CALINSKI}
      SELECT '{name}' AS labelling, (SELECT count(DISTINCT cluster) FROM vecs) AS n_clusters,
        (SELECT count(*) FROM vecs WHERE cluster = -1) AS n_noise, (SELECT count(*) FROM vecs) AS n_samples,
        {oracles.r6('(SELECT s FROM sil)', 'silhouette_score')}, CAST(NULL AS DOUBLE) AS silhouette_sq, 'exact' AS silhouette_kind,
        {oracles.r6('(SELECT v FROM db)', 'davies_bouldin')}, {oracles.r6('(SELECT v FROM ch)', 'calinski_harabasz')},
        {oracles.r6('(SELECT sum(ss) FROM spread)', 'inertia')},
        (SELECT min(n) FROM {sizes}) AS min_cluster_size, (SELECT max(n) FROM {sizes}) AS max_cluster_size,
        {oracles.r6(f'(SELECT avg(n) FROM {sizes})', 'avg_cluster_size')})"""


register(
    "quality_rows",
    lambda s, d: metrics.quality_table(_three_labellings(s, d), silhouette="exact").drop("silhouette_estimate", "silhouette_error"),
    " UNION ALL ".join(
        _quality_sql(name, label)
        for name, label in (
            ("label", "label"),
            ("mod3", "vec_id % 3"),
            ("noisy", "(CASE WHEN vec_id % 5 = 0 THEN -1 ELSE label END)"),
        )
    ),
)
register(
    "silhouette_squared",
    lambda s, d: s.createDataFrame(
        [(metrics.silhouette_squared(metrics.one_labelling(labelled_vectors(s, d)), "labels"),)], "silhouette_sq double"
    ),
    f"WITH {oracles.VECTORS}, {oracles.SILHOUETTE.replace('sum(list_distance(a.e, b.e))', 'sum(list_distance(a.e, b.e) ** 2)')} "
    f"SELECT {oracles.r6('s', 'silhouette_sq')} FROM sil",
)
_JUDGED = f"""judged AS (SELECT * FROM vecs WHERE id % 20 = 0), n_of AS (SELECT cluster, count(*) AS size FROM vecs GROUP BY 1),
  to_cluster AS (SELECT a.id, a.cluster AS own, b.cluster, sum(list_distance(a.e, b.e)) AS total FROM judged a, vecs b GROUP BY ALL),
  ab AS (SELECT id, own, max(total / (size - 1)) FILTER (cluster = own) AS a, min(total / size) FILTER (cluster <> own) AS b
    FROM to_cluster JOIN n_of USING (cluster) GROUP BY ALL),
  est AS (SELECT own AS cluster, count(*) AS m, avg((b - a) / greatest(a, b)) AS s, var_samp((b - a) / greatest(a, b)) AS v FROM ab GROUP BY 1)"""
register(
    "silhouette_estimate",
    lambda s, d: metrics.silhouette_estimate(metrics.one_labelling(labelled_vectors(s, d)), picked=F.col("id") % 20 == 0).drop("labelling"),
    f"""WITH {oracles.VECTORS}, {_JUDGED} SELECT CAST(cluster AS INTEGER) AS cluster, size AS n_rows, m AS n_sampled, {oracles.r6('s', 'silhouette')},
      {oracles.r6('sqrt(v / m * (1 - m / size))', 'std_error')} FROM est JOIN n_of USING (cluster)""",
)
register(
    "knn_edges",
    lambda s, d: neighbours.knn_edges(labelled_vectors(s, d), 10, labelled_vectors(s, d).where("id % 20 = 0")),
    f"""WITH {oracles.VECTORS}, near AS (SELECT a.id, b.id AS neighbour, list_distance(a.e, b.e) AS distance FROM vecs a JOIN vecs b ON a.id <> b.id WHERE a.id % 20 = 0),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS pos FROM near)
    SELECT id, neighbour, CAST(pos AS INTEGER) AS rank, {oracles.r6('distance')} FROM ranked WHERE pos <= 10""",
)
register(
    "adjusted_rand",
    lambda s, d: metrics.adjusted_rand(labelled_vectors(s, d).withColumn("other", F.col("id") % 10), "cluster", "other"),
    f"""WITH t AS (SELECT label AS a, vec_id % 10 AS b FROM embeddings),
      c AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT count(*) AS n FROM t GROUP BY a, b)),
      ra AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT count(*) AS n FROM t GROUP BY a)),
      rb AS (SELECT sum(n * (n - 1) / 2) AS s FROM (SELECT count(*) AS n FROM t GROUP BY b)),
      p AS (SELECT count(*) * (count(*) - 1) / 2 AS s FROM t)
    SELECT {oracles.r6('((c.s - ra.s * rb.s / p.s) / ((ra.s + rb.s) / 2 - ra.s * rb.s / p.s))', 'adjusted_rand')} FROM c, ra, rb, p""",
)


def _nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One assignment step with the label means as centres."""
    rows = labelled_vectors(spark, sf_dir)
    means = metrics.centroids(metrics.exploded(metrics.one_labelling(rows))).orderBy("cluster")
    centres = np.array([r["centre"] for r in means.collect()])
    return assign(rows.select("id", "features"), {"nearest": centres}).select("id", "nearest")


register(
    "nearest_centroid",
    _nearest,
    f"WITH {oracles.VECTORS}, {oracles.CENTROIDS} "
    "SELECT id, CAST(arg_min(cents.cluster, list_distance(e, c)) AS INTEGER) AS nearest FROM vecs, cents GROUP BY id",
)


def _inertia_by_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inertia of the labels ``id % k`` for every K of the sweep."""
    rows = labelled_vectors(spark, sf_dir)
    entries = [x for k in settings.K_RANGE for x in (F.lit(str(k)), (F.col("id") % k).cast("int"))]
    long = metrics.exploded(rows.select("id", "features", F.create_map(*entries).alias("labels")))
    return metrics.between_scores(long).select(F.col("labelling").cast("int").alias("k"), "inertia")


_INERTIA_CTES = f"""{oracles.VECTORS.replace('label AS cluster', 'vec_id')},
  parts AS (SELECT id, k, id % k AS cluster, unnest(e) AS x, generate_subscripts(e, 1) AS pos FROM vecs, range(2, 11) AS ks(k)),
  means AS (SELECT k, cluster, pos, avg(x) AS m FROM parts GROUP BY ALL),
  scores AS (SELECT CAST(k AS INTEGER) AS k, sum((x - m) ** 2) AS inertia FROM parts JOIN means USING (k, cluster, pos) GROUP BY 1)"""
register("inertia_by_k", _inertia_by_k, f"WITH {_INERTIA_CTES} SELECT k, {oracles.r6('inertia')} FROM scores")
register(
    "elbow_reference",
    lambda s, d: kselect.elbow_reference(_inertia_by_k(s, d)),
    f"""WITH {_INERTIA_CTES},
      d AS (SELECT k, inertia - lead(inertia) OVER (ORDER BY k) AS drop, lead(k) OVER (ORDER BY k) AS next_k FROM scores),
      r AS (SELECT *, CASE WHEN lead(drop) OVER (ORDER BY k) > 0 THEN drop / lead(drop) OVER (ORDER BY k)
                          WHEN lead(drop) OVER (ORDER BY k) IS NOT NULL THEN 0 END AS rate FROM d)
    SELECT coalesce((SELECT next_k FROM r WHERE rate < 0.5 ORDER BY k LIMIT 1), (SELECT k FROM scores ORDER BY k LIMIT 1 OFFSET 1)) AS optimal_k""",
)
register(
    "elbow_knee",
    lambda s, d: kselect.elbow_knee(_inertia_by_k(s, d)),
    f"""WITH {_INERTIA_CTES}, ends AS (SELECT min(k) AS k0, max(k) AS k1, arg_min(inertia, k) AS i0, arg_max(inertia, k) AS i1 FROM scores)
    SELECT k AS optimal_k FROM scores, ends ORDER BY i0 + (k - k0) / (k1 - k0) * (i1 - i0) - inertia DESC, k LIMIT 1""",
)
register(
    "cluster_sizes",
    lambda s, d: profiles.cluster_sizes(labelled_vectors(s, d)),
    f"""SELECT CAST(label AS INTEGER) AS cluster, count(*) AS cluster_size,
      {oracles.r6('(count(*) / (SELECT count(*) FROM embeddings))', 'share')} FROM embeddings GROUP BY 1""",
)
register(
    "cluster_size_summary",
    lambda s, d: profiles.size_summary(labelled_vectors(s, d)),
    f"""WITH c AS (SELECT count(*) AS n FROM embeddings GROUP BY label)
    SELECT min(n) AS min_cluster_size, max(n) AS max_cluster_size, {oracles.r6('avg(n)', 'avg_cluster_size')} FROM c""",
)
register(
    "quality_grades",
    lambda s, d: profiles.grade(
        metrics.quality_table(_three_labellings(s, d), silhouette="exact").select(
            "labelling", "silhouette_score", "davies_bouldin"
        )
    ).select("labelling", "silhouette_grade", "separation_grade"),
    f"""SELECT labelling, CASE WHEN silhouette_score > 0.5 THEN 'Excellent' WHEN silhouette_score > 0.3 THEN 'Good' ELSE 'Fair' END AS silhouette_grade,
      CASE WHEN davies_bouldin < 1 THEN 'separate' WHEN davies_bouldin < 2 THEN 'touching' ELSE 'mixed' END AS separation_grade FROM ({ORACLES['quality_rows']})""",
)

# --- profiles of given clusters over the customers ----------------------------

_PROFILED = [
    "total_events", "view_count", "purchase_count", "total_spending", "avg_order_value", "unique_products_viewed",
    "unique_categories", "time_span_hours", "purchase_conversion_rate", "avg_session_duration_hours", "price_std",
    "days_since_last_event",
]


def _clustered(events: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Customers with a given cluster, the user id modulo 4."""
    kept = customers.customer_features(events, columns=columns or _PROFILED)
    return kept.withColumn("cluster", (F.col("user_id") % 4).cast("int"))


def _clustered_ctes(source: str) -> str:
    return f"{oracles.CUSTOMERS[source]}, cl AS (SELECT *, CAST(user_id % 4 AS INTEGER) AS cluster FROM cust)"


def _profile_long(source: str) -> str:
    means = " UNION ALL ".join(f"SELECT cluster, '{c}' AS feature, avg({c}) AS mean FROM cl GROUP BY 1" for c in _PROFILED)
    return f"{_clustered_ctes(source)}, prof AS ({means})"


def _profiles(events: DataFrame) -> DataFrame:
    return profiles.cluster_profiles(_clustered(events), _PROFILED)


_register_per_source(
    "cluster_profiles",
    _profiles,
    lambda source: f"WITH {_clustered_ctes(source)} SELECT cluster, {', '.join(oracles.r6(f'avg({c})', c) for c in _PROFILED)}, "
    "count(*) AS cluster_size FROM cl GROUP BY 1",
)
_register_per_source(
    "top_variance_features",
    lambda ev: profiles.top_variance_features(_profiles(ev), 10),
    lambda source: f"WITH {_profile_long(source)}, v AS (SELECT feature, var_samp(mean) AS v FROM prof GROUP BY 1) "
    f"SELECT feature, {oracles.r6('v', 'variance')} FROM v ORDER BY v DESC NULLS LAST, feature LIMIT 10",
)
_NORMALISED_SQL = (
    f"SELECT cluster, feature, {oracles.r6('mean')}, {oracles.r6('((mean - min(mean) OVER w) / (max(mean) OVER w - min(mean) OVER w + 1e-8))', 'normalised')} "
    "FROM prof {where} WINDOW w AS (PARTITION BY feature)"
)
_register_per_source(
    "profile_minmax",
    lambda ev: profiles.normalised_profiles(_profiles(ev)),
    lambda source: f"WITH {_profile_long(source)} " + _NORMALISED_SQL.format(where=""),
)
_register_per_source(
    "radar_profiles",
    lambda ev: profiles.radar_profiles(_profiles(ev), _PROFILED),
    lambda source: f"WITH {_profile_long(source)} "
    + _NORMALISED_SQL.format(where="WHERE feature IN (" + ", ".join(f"'{c}'" for c in _PROFILED[:8]) + ")"),
)


def _business(events: DataFrame) -> DataFrame:
    needs = [*_RFM_INPUT, "purchase_conversion_rate", "unique_products_viewed", "unique_categories"]
    kept = customers.customer_features(events, columns=needs).persist()
    return profiles.business_summary(rfm.rfm_scores(kept).withColumn("cluster", (F.col("user_id") % 4).cast("int")))


_BUSINESS = {
    "avg_events": "avg(total_events)", "avg_purchases": "avg(purchase_count)",
    "avg_spending": "avg(total_spending) FILTER (total_spending > 0)", "total_revenue": "sum(total_spending)",
    "conversion_rate": "avg(purchase_conversion_rate)", "avg_products": "avg(unique_products_viewed)",
    "avg_categories": "avg(unique_categories)", "avg_recency_score": "avg(recency_score)",
    "avg_frequency_score": "avg(frequency_score)", "avg_monetary_score": "avg(monetary_score)",
    "share": "(count(*) / (SELECT count(*) FROM rfm))",
}
_register_per_source(
    "cluster_business_summary",
    _business,
    lambda source: f"WITH {oracles.RFM[source]} SELECT CAST(user_id % 4 AS INTEGER) AS cluster, count(*) AS cluster_size, "
    + ", ".join(oracles.r6(f"({expr})", name) for name, expr in _BUSINESS.items())
    + " FROM rfm GROUP BY 1",
)
_register_per_source(
    "histogram_by_cluster",
    lambda ev: eda.histogram_by_cluster(_clustered(ev, ["total_spending"]).persist(), "total_spending"),
    lambda source: f"""WITH {_clustered_ctes(source)}, ends AS (SELECT cluster, min(total_spending) AS lo, max(total_spending) AS hi FROM cl GROUP BY 1),
    filled AS (SELECT cluster, CASE WHEN hi > lo THEN least(CAST(floor((total_spending - lo) / (hi - lo) * 30) AS INTEGER), 29) ELSE 15 END AS bin,
      count(*) AS n FROM cl JOIN ends USING (cluster) GROUP BY ALL)
    SELECT e.cluster, CAST(b AS INTEGER) AS bin, coalesce(n, 0) AS n FROM ends e JOIN range(30) AS t(b) ON true
      LEFT JOIN filled f ON f.cluster = e.cluster AND f.bin = b""",
)

# --- clustering ---------------------------------------------------------------


def _embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labelled_vectors(spark, sf_dir).select("id", "features")


def _customer_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scaled customer vectors, as the clustering step of the whole job sees them."""
    features = engineer.select_features(_engineered(events_canonical(spark, sf_dir)), engineer.RECOMMENDED_EXCLUDES)
    return preprocess.Preprocessor().fit(features).vectors(features).persist()


register(
    "dbscan",
    lambda s, d: dbscan(_embedding_points(s, d), 1.15, 3),
    oracles.dbscan("pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings)", 1.15, 3),
)


def _dbscan_customers(events: DataFrame) -> DataFrame:
    kept = customers.customer_features(events, columns=["view_count", "cart_count", "purchase_count"])
    return dbscan(preprocess.to_vectors(kept, "user_id", ["view_count", "cart_count", "purchase_count"]), 2.0, 4)


_register_per_source(
    "dbscan_customers",
    _dbscan_customers,
    lambda source: oracles.dbscan(
        f"{oracles.CUSTOMERS[source]}, pts AS (SELECT user_id AS id, [CAST(view_count AS DOUBLE), cart_count, purchase_count] AS e FROM cust)",
        2.0,
        4,
    ),
)


def _three_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three Lloyd steps from the vectors 0, 1 and 2, and the clusters they lead to."""
    rows = _embedding_points(spark, sf_dir)
    first = rows.where("id < 3").orderBy("id").collect()  # the three given centres
    fit = lloyd(rows, np.array([r["features"] for r in first]), 3)
    sizes = fit.assign(rows).groupBy("cluster").agg(F.count(F.lit(1)).alias("n_rows"))
    return sizes.withColumn("cost", F.lit(fit.cost))


register("kmeans_three_steps", _three_steps, oracles.three_lloyd_steps())


def _picked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The K that each rule picks from the scores of the labellings ``id % k``."""
    rows = labelled_vectors(spark, sf_dir)
    entries = [x for k in settings.K_RANGE for x in (F.lit(str(k)), (F.col("id") % k).cast("int"))]
    table = metrics.quality_table(rows.select("id", "features", F.create_map(*entries).alias("labels")), silhouette="both")
    table = table.withColumn("n_clusters", F.col("labelling").cast("int")).persist()
    methods = [m for m in kselect.METHODS if m not in ("stability", "silhouette_estimate")]
    return spark.createDataFrame([(m, kselect.pick_k(table, m)) for m in methods], "method string, k int")


register("picked_k", _picked, oracles.picked_k(_INERTIA_CTES))
register(
    "adjusted_rand_by_k",
    lambda s, d: metrics.adjusted_rand(
        labelled_vectors(s, d)
        .withColumn("k", F.explode(F.array(*map(F.lit, settings.K_RANGE))))
        .withColumn("other", F.col("id") % F.col("k")),
        "cluster",
        "other",
        by=["k"],
    ),
    f"""WITH t AS (SELECT k, label AS a, vec_id % k AS b FROM embeddings, range(2, 11) AS ks(k)),
      c AS (SELECT k, sum(n * (n - 1) / 2) AS s FROM (SELECT k, count(*) AS n FROM t GROUP BY k, a, b) GROUP BY 1),
      ra AS (SELECT k, sum(n * (n - 1) / 2) AS s FROM (SELECT k, count(*) AS n FROM t GROUP BY k, a) GROUP BY 1),
      rb AS (SELECT k, sum(n * (n - 1) / 2) AS s FROM (SELECT k, count(*) AS n FROM t GROUP BY k, b) GROUP BY 1),
      p AS (SELECT k, count(*) * (count(*) - 1) / 2 AS s FROM t GROUP BY 1)
    SELECT CAST(k AS INTEGER) AS k, {oracles.r6('((c.s - ra.s * rb.s / p.s) / ((ra.s + rb.s) / 2 - ra.s * rb.s / p.s))', 'adjusted_rand')}
    FROM c JOIN ra USING (k) JOIN rb USING (k) JOIN p USING (k)""",
)


def _labels(algorithm: str, points=_customer_points, **params) -> Query:
    return lambda s, d: segments.segment(points(s, d), algorithm, **params).labels


register("kmeans", _labels("kmeans", k=5))
register("kmeans_embeddings", _labels("kmeans", _embedding_points, k=10))
register("gmm", _labels("gmm", k=3))
register("bisecting", _labels("bisecting", k=5))
register("agglomerative", _labels("agglomerative", k=5))
register("spectral", _labels("spectral", k=5))
register("k_selection", lambda s, d: kselect.evaluate_k(_customer_points(s, d))[0])


def _label_facts(algorithm: str, points: Query, n: str, **params) -> None:
    """What must hold of any labelling: every row once, k clusters numbered from 0; and for K-means that
    no row is nearer to another centre and the cost is that of the labels."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = points(spark, sf_dir)
        made = segments.segment(rows, algorithm, **params)
        labels = made.labels.persist()
        facts = labels.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("id").alias("n_ids"),
            F.count_distinct("cluster").alias("n_clusters"),
            F.min("cluster").alias("lowest"),
            F.max("cluster").alias("highest"),
        )
        if algorithm != "kmeans":
            return facts
        centres = made.model.centers
        d2 = [squared_distance(F.col("features"), F.array(*map(F.lit, map(float, c)))) for c in centres]
        near = rows.join(labels, "id").select("cluster", F.array(*d2).alias("d2"))
        own = F.get("d2", F.col("cluster"))
        more = near.agg(F.count_if(own > F.array_min("d2") + 1e-9).alias("misplaced"), F.sum(own).alias("cost")).first()
        agrees = bool(abs(more["cost"] - made.model.cost) <= 1e-6 * made.model.cost)
        return facts.withColumns({"misplaced": F.lit(more["misplaced"]), "cost_agrees": F.lit(agrees)})

    k = params["k"]
    extra = ", CAST(0 AS BIGINT) AS misplaced, true AS cost_agrees" if algorithm == "kmeans" else ""
    register(
        f"{algorithm}_facts",
        run,
        f"SELECT {n} AS n_rows, {n} AS n_ids, CAST({k} AS BIGINT) AS n_clusters, CAST(0 AS INTEGER) AS lowest, CAST({k - 1} AS INTEGER) AS highest{extra}",
    )


_USERS = "(SELECT count(DISTINCT user_id) FROM events)"
_label_facts("kmeans", _customer_points, _USERS, k=5)
_label_facts("gmm", _customer_points, _USERS, k=3)
_label_facts("bisecting", _customer_points, _USERS, k=5)
_label_facts("agglomerative", _customer_points, _USERS, k=5)
_label_facts("spectral", _customer_points, _USERS, k=5)
register("k_stability", lambda s, d: kselect.stability_scores(_customer_points(s, d), settings.K_RANGE))
register("algorithm_comparison", lambda s, d: segments.compare_algorithms(_customer_points(s, d), 4)[0])


def _projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    model, df = _fitted(events_canonical(spark, sf_dir))
    scaled = model.transform(df)
    return profiles.pca_projection(scaled, model.feature_names, 2, keep=("user_id",))[0]


register("pca_projection", _projection)


def _segmented(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = job.segment_customers(events_canonical(spark, sf_dir), algorithm="kmeans")
    return profiles.business_summary(result.customers)


register("customer_segments", _segmented)


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = job.segment_customers(events_canonical(spark, sf_dir), algorithm="bisecting")
    return spark.createDataFrame([(i, line) for i, line in enumerate(result.report.split("\n"))], "line_no int, line string")


register("cluster_report", _report)


def _whole_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job as it is run without further wishes: K chosen, all algorithms compared, the best kept and reported."""
    result = job.segment_customers(events_canonical(spark, sf_dir))
    return spark.createDataFrame([(i, line) for i, line in enumerate(result.report.split("\n"))], "line_no int, line string")


register("segment_report", _whole_job)
