"""Event log -> one row per customer.

Three reads of the log, each column-pruned and each combined map-side:

* additive measures, grouped by customer;
* distinct values per customer (sessions, categories, products, brands, times,
  hours) as grouping sets, folded to one row per customer by a second hash
  aggregate, so that a customer with a third of all events still spreads over
  every task of the first one;
* one global minimum time.

Both grouped sides end hash-partitioned on the customer and join without
another exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions import hours_between, ratio

#: Events whose distinct values one task collects: a hash table holds a row for most of an event's values.
EVENTS_PER_TASK = 200_000
_ID_SPAN = 10**20  # wider than any bigint, so (count, id) packs into one decimal
_ID_TOP = 2**63 - 1


def _measures(events: DataFrame, key: str) -> DataFrame:
    purchase, view = F.col("event_type") == "purchase", F.col("event_type") == "view"
    bought, viewed = F.when(purchase, F.col("price")), F.when(view, F.col("price"))

    def where_any(rows: Column, value: Column) -> Column:
        return F.when(F.count_if(rows) > 0, value).otherwise(F.lit(0.0))

    return events.groupBy(key).agg(
        F.count(F.lit(1)).alias("total_events"),
        F.count_if(view).alias("view_count"),
        F.count_if(F.col("event_type") == "cart").alias("cart_count"),
        F.count_if(purchase).alias("purchase_count"),
        F.coalesce(F.sum(bought), F.lit(0.0)).alias("total_spending"),
        where_any(purchase, F.avg(bought)).alias("avg_order_value"),
        where_any(purchase, F.max(bought)).alias("max_order_value"),
        where_any(purchase, F.min(bought)).alias("min_order_value"),
        where_any(view, F.avg(viewed)).alias("avg_price_viewed"),
        where_any(view, F.stddev_samp(viewed)).alias("price_std"),
        where_any(view, F.max(viewed) - F.min(viewed)).alias("price_range"),
        F.min("event_time").alias("first_event_time"),
        F.max("event_time").alias("last_event_time"),
    )


def _dealt(events: DataFrame, key: str) -> DataFrame:
    """The events over tasks of ``EVENTS_PER_TASK`` on average, whatever the size of the files they are read from.

    They are dealt by customer, time and product, so that a customer with a third of all events still spreads over
    every task.
    """
    by = [c for c in (key, "_t", "product_id") if c in events.columns]
    tasks = -(-events.count() // EVENTS_PER_TASK)
    return events.repartition(tasks, *by) if tasks > 1 else events


def _facets(events: DataFrame, key: str, names: list[str], preferred: bool) -> DataFrame:
    events = events.withColumn("event_hour", F.hour("event_time"))
    # event_time is both a facet and a measure: the measure needs its own column.
    parts = events.select(key, *names, F.col("event_time").alias("_t"), (F.col("event_type") == "purchase").alias("_buy"))
    sets = _dealt(parts, key).groupingSets([[F.col(key), F.col(c)] for c in names], key, *names).agg(
        F.grouping_id().alias("_gid"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("_buy").alias("n_buy"),
        F.min("_t").alias("t0"),
        F.max("_t").alias("t1"),
    )
    # grouping_id sets the bit of every column that is NOT in the grouping set.
    bits = {c: 1 << (len(names) - 1 - i) for i, c in enumerate(names)}
    full = (1 << len(names)) - 1

    def facet(name: str) -> Column:
        if name not in bits:
            return F.lit(False)
        return (F.col("_gid") == full - bits[name]) & F.col(name).isNotNull()

    def distinct(name: str) -> Column:
        return F.count_if(facet(name))

    n = F.col("n")
    long_session = facet("user_session") & (n > 1)
    session_hours = F.when(long_session, hours_between(F.col("t0"), F.col("t1")))
    out = {
        "product_id": [
            distinct("product_id").alias("unique_products_viewed"),
            F.count_if(facet("product_id") & (F.col("n_buy") > 0)).alias("unique_products_purchased"),
        ],
        "category_id": [
            distinct("category_id").alias("unique_categories"),
            F.sum(F.when(facet("category_id"), n.cast("double") * n)).alias("category_squares"),
            _modal_id(facet("category_id"), n, F.col("category_id")).alias("top_category_id"),
        ],
        "brand": [distinct("brand").alias("unique_brands")],
        "event_time": [distinct("event_time").alias("distinct_times")],
        "event_hour": [_modal_hour(facet("event_hour"), n, F.col("event_hour")).alias("peak_activity_hour")],
        "user_session": [
            distinct("user_session").alias("unique_sessions"),
            F.coalesce(F.avg(session_hours), F.lit(0.0)).alias("avg_session_duration_hours"),
            F.coalesce(F.max(session_hours), F.lit(0.0)).alias("max_session_duration_hours"),
        ],
    }
    out = [expr for name in names for expr in out.get(name, [])]
    if preferred:
        out += [
            F.min(F.when(facet(c), F.struct((-n).alias("n"), F.col(c).alias("v"))))["v"].alias(f"most_frequent_{c}")
            for c in ("brand", "category_code")
            if c in names
        ]
    return sets.groupBy(key).agg(*out)


def _modal_hour(member: Column, n: Column, hour: Column) -> Column:
    """Most frequent hour, earliest on ties."""
    return (31 - F.max(F.when(member, n * 32 + (31 - hour))) % 32).cast("int")


def _modal_id(member: Column, n: Column, value: Column) -> Column:
    """Most frequent id, smallest on ties, as a max over a fixed-width number.

    A struct buffer would turn the hash aggregate into a sort aggregate.
    """
    span, top = F.lit(str(_ID_SPAN)).cast("decimal(21,0)"), F.lit(str(_ID_TOP)).cast("decimal(20,0)")
    packed = (n.cast("decimal(16,0)") * span + (top - value.cast("decimal(20,0)"))).cast("decimal(38,0)")
    best = F.max(F.when(member, packed))
    return (top - best % span).cast("bigint")


# Which distinct-value scan each column comes from; the others are plain measures.
_FACET_OF = {
    "unique_products_viewed": "product_id",
    "unique_products_purchased": "product_id",
    "product_diversity": "product_id",
    "unique_categories": "category_id",
    "category_diversity": "category_id",
    "category_concentration": "category_id",
    "top_category_id": "category_id",
    "unique_brands": "brand",
    "brand_diversity": "brand",
    "avg_time_between_events_hours": "event_time",
    "peak_activity_hour": "event_hour",
    "unique_sessions": "user_session",
    "avg_events_per_session": "user_session",
    "avg_session_duration_hours": "user_session",
    "max_session_duration_hours": "user_session",
}


def customer_features(
    events: DataFrame, key: str = "user_id", preferred: bool = False, columns: list[str] | None = None
) -> DataFrame:
    """One row per customer with counts, spending, variety, timing, rates, sessions and prices.

    Events without a customer are dropped.  ``preferred`` adds the modal brand
    and category code used by the frequency encoding.  ``columns`` asks for some
    columns only, and leaves out the work behind the others.
    """
    wanted = list(columns or CUSTOMER_COLUMNS)
    modal = [c for c in ("brand", "category_code") if preferred and c in events.columns]
    facets = list(dict.fromkeys([*(_FACET_OF[c] for c in wanted if c in _FACET_OF), *modal]))
    facets = [f for f in facets if f == "event_hour" or f in events.columns]
    events = events.where(F.col(key).isNotNull())
    start = events.agg(F.min("event_time")).scalar()
    base = _measures(events, key)
    if facets:
        base = base.join(_facets(events, key, facets, preferred), key)
    if "brand" not in events.columns:
        base = base.withColumn("unique_brands", F.lit(0).cast("bigint"))
    total = F.col("total_events")
    span = F.greatest(hours_between(F.col("first_event_time"), F.col("last_event_time")), F.lit(0.0))

    def days_since(col: str) -> Column:
        # Whole 24-hour periods, not calendar days.
        return F.floor(F.timestamp_diff("SECOND", start, F.col(col)) / 86400).cast("bigint")

    bounced = F.when(F.col("view_count") > 0, F.lit(float("inf"))).otherwise(F.lit(0.0))
    extra = {
        "time_span_hours": span,
        # Positive gaps between consecutive times add up to the span, and there is
        # one fewer of them than there are distinct times: no ordering needed.
        "avg_time_between_events_hours": ratio(span, F.col("distinct_times") - 1),
        "purchase_conversion_rate": ratio(F.col("purchase_count"), F.col("view_count")),
        "cart_conversion_rate": ratio(F.col("cart_count"), F.col("view_count")),
        "cart_abandonment_rate": F.when(
            F.col("cart_count") > 0, 1 - F.col("purchase_count") / F.col("cart_count")
        ).otherwise(F.lit(0.0)),
        "browse_to_buy_ratio": F.when(
            F.col("purchase_count") > 0, F.col("view_count") / F.col("purchase_count")
        ).otherwise(bounced),
        "product_diversity": F.col("unique_products_viewed") / total,
        "category_diversity": F.col("unique_categories") / total,
        "brand_diversity": F.col("unique_brands") / total,
        "category_concentration": F.coalesce(F.col("category_squares") / (total.cast("double") * total), F.lit(0.0)),
        "avg_events_per_session": ratio(total, F.col("unique_sessions")),
        "days_since_first_event": days_since("first_event_time"),
        "days_since_last_event": days_since("last_event_time"),
    }
    derived = {name: extra[name].alias(name) for name in wanted if name in extra}
    return base.select(key, *[derived.get(c, F.col(c)) for c in wanted], *[f"most_frequent_{c}" for c in modal])


CUSTOMER_COLUMNS = [
    "total_events",
    "view_count",
    "cart_count",
    "purchase_count",
    "total_spending",
    "avg_order_value",
    "max_order_value",
    "min_order_value",
    "avg_price_viewed",
    "unique_products_viewed",
    "unique_products_purchased",
    "unique_categories",
    "unique_brands",
    "unique_sessions",
    "time_span_hours",
    "avg_time_between_events_hours",
    "peak_activity_hour",
    "purchase_conversion_rate",
    "cart_conversion_rate",
    "cart_abandonment_rate",
    "browse_to_buy_ratio",
    "product_diversity",
    "category_diversity",
    "brand_diversity",
    "category_concentration",
    "top_category_id",
    "avg_events_per_session",
    "avg_session_duration_hours",
    "max_session_duration_hours",
    "price_std",
    "price_range",
    "days_since_first_event",
    "days_since_last_event",
]
