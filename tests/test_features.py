"""Hand-computed edge cases of the customer features."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from segmentry.operators import customers, engineer, quality, rfm
from segmentry.sources import coerce_events

SCHEMA = (
    "event_time timestamp_ntz, event_type string, product_id bigint, category_id bigint, category_code string, "
    "brand string, price double, user_id bigint, user_session string"
)


def at(hour, minute=0, day=1):
    return dt.datetime(2024, 1, day, hour, minute)


@pytest.fixture
def events(spark):
    rows = [
        # user 1: one view, one cart, two purchases, one of them without a price
        (at(10), "view", 1, 7, "a.b", "x", 10.0, 1, "s1"),
        (at(10), "cart", 1, 7, "a.b", "x", 10.0, 1, "s1"),
        (at(12), "purchase", 2, 8, None, "y", 30.0, 1, "s1"),
        (at(13), "purchase", 3, 8, None, None, None, 1, "s2"),
        # user 2: views only, never buys
        (at(9), "view", 1, 7, "a.b", "x", 10.0, 2, "s3"),
        (at(8, day=3), "view", 2, 6, "c", "z", 20.0, 2, "s4"),
        # user 3: a single event of another type, no session, no category
        (at(9, day=2), "remove", 5, None, None, None, 5.0, 3, None),
        # an event without a user
        (at(0), "view", 9, 9, "q", "q", 1.0, None, "s9"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture
def by_user(events):
    return {r["user_id"]: r for r in customers.customer_features(events, preferred=True).collect()}


def test_null_users_are_dropped(by_user):
    assert set(by_user) == {1, 2, 3}


def test_spending(by_user):
    one = by_user[1]
    assert (one["purchase_count"], one["total_spending"], one["avg_order_value"]) == (2, 30.0, 30.0)
    assert (by_user[2]["total_spending"], by_user[2]["max_order_value"]) == (0.0, 0.0)


def test_single_view_has_no_spread(by_user):
    assert by_user[1]["price_std"] is None
    assert by_user[1]["price_range"] == 0.0
    assert by_user[2]["price_std"] == pytest.approx(math.sqrt(50))
    assert by_user[3]["price_std"] == 0.0


def test_rates(by_user):
    assert by_user[1]["purchase_conversion_rate"] == 2.0
    assert by_user[1]["cart_abandonment_rate"] == -1.0
    assert by_user[2]["browse_to_buy_ratio"] == math.inf
    assert by_user[3]["browse_to_buy_ratio"] == 0.0


def test_gaps_skip_equal_times(by_user):
    assert by_user[1]["avg_time_between_events_hours"] == pytest.approx(1.5)
    assert by_user[3]["avg_time_between_events_hours"] == 0.0


def test_modes_take_the_smallest_on_ties(by_user):
    assert by_user[1]["top_category_id"] == 7
    assert by_user[2]["top_category_id"] == 6
    assert by_user[2]["peak_activity_hour"] == 8
    assert by_user[3]["top_category_id"] is None
    assert by_user[2]["most_frequent_brand"] == "x"


def test_mode_of_negative_and_large_ids(spark):
    rows = [(at(1), "view", 1, c, None, None, 1.0, 1, "s") for c in (-(2**62), -(2**62), 2**62, 2**62)]
    row = customers.customer_features(spark.createDataFrame(rows, SCHEMA)).first()
    assert row["top_category_id"] == -(2**62)


def test_sessions(by_user):
    assert by_user[1]["avg_session_duration_hours"] == 2.0  # the one-event session does not count
    assert by_user[2]["avg_session_duration_hours"] == 0.0
    assert by_user[3]["avg_events_per_session"] == 0.0


def test_concentration_counts_missing_categories_in_the_total(by_user):
    assert by_user[1]["category_concentration"] == pytest.approx(0.5)
    assert by_user[3]["category_concentration"] == 0.0


def test_days_are_whole_periods_from_the_first_event(by_user):
    assert by_user[2]["days_since_last_event"] == 1  # 47 hours
    assert by_user[1]["days_since_first_event"] == 0


def test_column_choice_equals_the_full_table(events):
    cols = ["brand_diversity", "avg_session_duration_hours"]
    full = customers.customer_features(events).select("user_id", *cols)
    assert sorted(map(tuple, customers.customer_features(events, columns=cols).collect())) == sorted(map(tuple, full.collect()))


def test_missing_brand_column(events):
    row = customers.customer_features(events.drop("brand")).first()
    assert row["unique_brands"] == 0


def test_quantile_scores_collapse_equal_edges(spark):
    rows = [(i, v, v, float(v), v) for i, v in enumerate([0, 0, 0, 0, 0, 0, 1, 2, 5])]
    df = spark.createDataFrame(rows, "user_id bigint, purchase_count bigint, total_events bigint, total_spending double, days_since_last_event bigint")
    out = rfm.rfm_scores(df).orderBy("user_id").collect()
    assert [r["frequency_score"] for r in out] == [1] * 7 + [2, 2]
    assert [r["recency_score"] for r in out] == [5] * 7 + [4, 4]
    same = rfm.rfm_scores(df.withColumns({"total_spending": F.lit(3.0)})).first()
    assert same["monetary_score"] is None


def test_as_of_recency(spark):
    df = spark.createDataFrame([(1, 1, 1, 1.0, 4), (2, 1, 1, 1.0, 9)], "user_id bigint, purchase_count bigint, total_events bigint, total_spending double, days_since_last_event bigint")
    assert [r["recency"] for r in rfm.add_rfm_columns(df, "as_of").orderBy("user_id").collect()] == [5, 0]
    with pytest.raises(ValueError):
        rfm.add_rfm_columns(df, "other")


def test_spending_level_of_zero(spark):
    df = spark.createDataFrame([(1, 3, 0, 0.0, 1.0)], "user_id bigint, total_events bigint, purchase_count bigint, total_spending double, time_span_hours double")
    assert engineer.behavioral_features(df).first()["spending_level"] is None
    assert engineer.behavioral_features(df, include_lowest=True).first()["spending_level"] == "No Purchase"


def test_fallbacks_for_missing_columns(spark):
    df = spark.createDataFrame([(1, 3, 2)], "user_id bigint, total_events bigint, purchase_count bigint")
    out = engineer.engineer_features(df).first()
    assert out["engagement_intensity"] == 3.0
    assert out["value_score"] == 2.0
    assert out["spending_level"] == "No Purchase"
    assert out["session_length_category"] == "Short"
    assert out["price_preference_percentile"] == 0.5
    assert (out["exploration_score"], out["focus_score"], out["brand_loyalty_score"]) == (0.0, 1.0, 0.0)


def test_frequency_scores(spark):
    rows = [(i, b, c) for i, (b, c) in enumerate(zip("ABACBA", "XYXZYX"))] + [(6, None, "X")]
    df = spark.createDataFrame(rows, "user_id bigint, brand string, category_code string")
    out = engineer.categorical_features(df).orderBy("user_id").collect()
    assert [round(r["brand_frequency_score"] * 6) for r in out] == [3, 2, 3, 1, 2, 3, 0]
    assert [round(r["brand_category_affinity"] * 7) for r in out] == [3, 2, 3, 1, 2, 3, 1]


def test_selection_keeps_numbers_and_drops_infinities(spark):
    df = spark.createDataFrame([(1, 2, math.inf, "x"), (2, 3, 1.0, "y")], "user_id bigint, a int, b double, c string")
    out = engineer.select_features(df).orderBy("user_id")
    assert out.columns == ["user_id", "a", "b"]
    assert [r["b"] for r in out.collect()] == [None, 1.0]


def test_coercion_and_checks(spark):
    rows = [("2019-10-01 00:00:00 UTC", "view", "12", "1.0", "3.5", "7"), ("junk", None, "x", "2", "NaN", None)]
    raw = spark.createDataFrame(rows, "event_time string, event_type string, product_id string, category_id string, price string, user_id string")
    out = coerce_events(raw)
    kinds = dict(out.dtypes)
    assert kinds["event_time"] == "timestamp" and kinds["product_id"] == "bigint" and kinds["price"] == "double"
    good, bad = out.orderBy(F.col("product_id").isNull()).collect()
    assert good["event_time"].year == 2019 and good["category_id"] == 1
    assert bad["event_time"] is None and bad["product_id"] is None and bad["price"] is None
    with pytest.raises(ValueError, match="user_session"):
        quality.check_events(out)


def test_empty_log_is_rejected(spark):
    with pytest.raises(ValueError, match="empty"):
        quality.check_events(spark.createDataFrame([], SCHEMA))


def test_duplicates_compare_nulls_equal(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "a"), (1, None)], "a int, b string")
    assert quality.duplicate_count(df).first()[0] == 2
