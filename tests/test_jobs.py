"""Cleaning, enrichment, star schema, findings and rules on small frames, with missing and empty input."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from nestmetrics.plans import clean, dashboard, eda, enrich, profile, rules, warehouse


def test_clean_listings_touches_only_what_is_there(spark):
    raw = spark.createDataFrame(
        [(1, "$1,200.00", "t", " Loft ", 0, None), (2, "", "f", None, 3, None), (3, None, "?", "Flat", 0, 1.5)],
        "id long, price string, host_is_superhost string, room_type string, number_of_reviews int, reviews_per_month double",
    )
    got = [tuple(r) for r in clean.clean_listings(raw).orderBy("id").collect()]
    assert got == [(1, 1200.0, True, "Loft", 0, 0.0), (2, None, False, None, 3, None), (3, None, None, "Flat", 0, 1.5)]
    assert clean.clean_listings(raw.select("id")).collect() == raw.select("id").collect()


def test_clean_is_one_narrow_stage(spark):
    raw = spark.createDataFrame([("2024-01-01", "t", "$1")], "date string, available string, price string")
    plan = clean.clean_calendar(raw)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_unknown_availability_counts_as_unavailable_but_not_as_known(spark):
    cal = spark.createDataFrame(
        [(1, True, 10.0), (1, None, 20.0), (1, False, None), (2, None, None), (None, True, 1.0)],
        "listing_id long, available boolean, price double",
    )
    got = {r.listing_id: tuple(r)[1:] for r in enrich.aggregate_calendar(cal).collect()}
    assert got == {1: (2, 2, 15.0, 1.0), 2: (0, 1, None, None)}


def test_review_counts_fall_back_to_listing_ids(spark):
    rev = spark.createDataFrame([(1, dt.date(2024, 1, 2)), (1, dt.date(2023, 1, 2))], "listing_id long, date date")
    assert tuple(enrich.aggregate_reviews(rev).first()) == (1, 2, dt.date(2023, 1, 2), dt.date(2024, 1, 2))
    with_id = rev.withColumn("id", F.lit(None).cast("long"))
    assert enrich.aggregate_reviews(with_id).first().total_review_count == 0


def test_enrichment_without_optional_inputs(spark):
    row = enrich.enrich_listings(spark.createDataFrame([(1,)], "id long")).first().asDict()
    assert row == {
        "id": 1, "host_tenure_years": None, "price_per_bedroom": None, "is_professional_host": False,
        "host_tier": "Solo Host", "estimated_annual_revenue_proxy": None,
    }


def test_unused_aggregates_are_dropped_from_the_plan(spark):
    listings = spark.range(5).selectExpr("id", "double(id) AS price")
    calendar = spark.range(7).selectExpr("id AS listing_id", "true AS available", "double(id) AS price")
    plan = enrich.enrich_listings(listings, calendar).select("price")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_star_tolerates_missing_columns_and_repeated_ids(spark):
    enriched = enrich.enrich_listings(
        spark.createDataFrame([(5, 70, "A"), (3, 71, "Z"), (5, 70, "A")], "id long, host_id long, neighbourhood_cleansed string")
    )
    areas = warehouse.dim_neighbourhood(spark.createDataFrame([("A",), ("B",), ("A",)], "neighbourhood string"))
    assert [tuple(r) for r in areas.orderBy("neighbourhood_key").collect()] == [(1, "A", None), (2, "B", None)]
    hosts = warehouse.dim_host(enriched)
    assert [(r.host_key, r.host_id, r.host_tier) for r in hosts.orderBy("host_key").collect()] == [
        (1, 70, "Solo Host"), (2, 71, "Solo Host"),
    ]
    dim = warehouse.dim_listing(enriched, areas, hosts)
    got = sorted((r.listing_key, r.listing_id, r.neighbourhood_key, r.host_key) for r in dim.collect())
    assert got == [(1, 3, None, 2), (2, 5, 1, 1), (3, 5, 1, 1)]
    fact = warehouse.fact_listing_snapshot(enriched, dim)
    assert sorted(r.listing_key for r in fact.collect()) == [1, 3, 3]
    assert fact.schema["price"].dataType.simpleString() == "double"


def test_null_host_tier_reads_nan(spark):
    df = spark.createDataFrame([(1, 9, 0)], "id long, host_id long, calculated_host_listings_count int")
    assert warehouse.dim_host(enrich.enrich_listings(df)).first().host_tier == "nan"


def test_profile_counts_and_ranges(spark):
    df = spark.createDataFrame(
        [(1518168294097881304, "2024-01-05", "a", 1.0), (2, "x", None, float("nan")), (2, "x", None, float("nan"))],
        "id long, last_review string, name string, score double",
    )
    got = {r.column_name: r for r in profile.profile_table(df, "k", "k.csv").collect()}
    assert (got["id"].min_value, got["id"].max_value) == ("2", "1518168294097881304")
    assert (got["last_review"].min_value, got["last_review"].unique_count) == ("2024-01-05", 2)
    assert (got["name"].missing_count, got["name"].missing_pct, got["name"].unique_count) == (2, 66.67, 1)
    assert got["name"].min_value is None
    assert (got["score"].missing_count, got["score"].unique_count, got["score"].max_value) == (2, 1, "1.0")
    assert {r.duplicate_rows for r in got.values()} == {1} and {r.row_count for r in got.values()} == {3}


def test_profile_reads_a_table_once_and_shuffles_no_texts(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(50).selectExpr("id", "repeat('long text ', 100) AS body", "decimal(id % 7) AS cost", "map('k', id % 2) AS m").write.parquet(path)
    df = spark.read.parquet(path)
    report = profile.profile_table(df, "t", "t.csv")
    plan = report._jdf.queryExecution()
    assert plan.optimizedPlan().toString().count("Relation [") == 1
    shuffled = [line for line in plan.executedPlan().toString().splitlines() if "Exchange hashpartitioning" in line]
    assert shuffled and not any("body" in line or "_text" in line for line in shuffled)
    got = {r.column_name: r for r in report.collect()}
    assert [got[c].unique_count for c in ("id", "body", "cost", "m")] == [50, 1, 7, 2]
    assert (got["cost"].min_value, got["cost"].max_value, got["cost"].duplicate_rows) == ("0", "6", 0)


def test_rows_are_equal_only_in_every_column(spark):
    rows = [(None, 1, "a"), (1, None, "a"), (None, 1, "a"), (None, None, "a"), (None, None, None), (None, None, None), (0, 0, "")]
    df = spark.createDataFrame(rows, "x int, y int, s string")
    assert profile.duplicate_rows(df).first().duplicate_rows == 2
    floats = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (float("nan"),), (None,)], "f double")
    assert profile.duplicate_rows(floats).first().duplicate_rows == 2
    assert profile.profile_table(floats, "f", "f.csv").first().unique_count == 1
    assert profile.duplicate_rows(df.limit(0)).first().duplicate_rows == 0


def test_profile_of_empty_and_broken_tables(spark):
    empty = spark.createDataFrame([], "a string, b int")
    report = profile.profile_tables(spark, {"e": ("e.csv", empty), "bad": ("bad.csv", ValueError("out of memory"))})
    got = {(r.file_key, r.column_name): r for r in report.collect()}
    assert got[("e", "a")].row_count == 0 and got[("e", "b")].missing_pct == 0.0
    assert got[("bad", "ERROR")].dtype == "out of memory"


def listings(spark, n=400):
    return spark.range(n).selectExpr(
        "id",
        "CASE WHEN id % 4 = 0 THEN 'Entire home/apt' WHEN id % 4 = 1 THEN 'Private room' END AS room_type",
        "CASE WHEN id % 5 = 4 THEN NULL WHEN id % 4 = 0 THEN double(300 + id % 7) ELSE double(100 + id % 7) END AS price",
        "concat('area ', id % 6) AS neighbourhood_cleansed",
        "CASE WHEN id % 3 > 0 THEN 3 + (id % 9) / 8D END AS review_scores_rating",
        "int(id % 366) AS availability_365",
        "id % 2 = 0 AS is_professional_host",
        "int(1 + id % 30) AS calculated_host_listings_count",
    )


def no_price_calendar(spark):
    return spark.range(60).selectExpr(
        "id AS listing_id", "date_add(date'2024-01-01', int(id)) AS date", "id % 2 = 0 AS available", "double(NULL) AS price"
    )


def test_every_calendar_price_job_survives_all_null_prices(spark):
    cal = no_price_calendar(spark)
    assert tuple(eda.weekend_vs_weekday(cal).first()) == (0.0, 0.0, 0.0)
    assert rules.rule_weekend_premium(cal).collect() == []
    assert dashboard.seasonality(cal).collect() == []
    assert dashboard.monthly_median_price(cal).collect() == []
    finding = eda.eda_insights(listings(spark), cal).orderBy("insight_id").collect()[-1].finding
    assert finding == "Weekend median: 0 THB, Weekday: 0 THB (+0.0% difference)."


def test_value_counts_and_medians_drop_null_keys_where_asked(spark):
    df = listings(spark)
    assert {r.room_type for r in eda.value_counts(df, "room_type").collect()} == {"Entire home/apt", "Private room"}
    assert {r.room_type for r in eda.price_by_room_type(df).collect()} == {"Entire home/apt", "Private room"}
    assert None in {r.room_type for r in dashboard.price_by_room(df).collect()}


def test_pricing_rule_wording(spark):
    row = rules.rule_pricing_gap(listings(spark)).first()
    assert row.finding == "Entire homes typically price at ฿303, while private rooms are ฿103."
    assert row.evidence_metric == "Entire vs Private gap: +194%"


def test_rules_are_silent_without_rows(spark):
    empty = listings(spark).limit(0)
    assert rules.recommendations(empty, no_price_calendar(spark).withColumn("price", F.col("listing_id") * 1.0)).collect() == []


def test_recommendations_are_numbered_without_gaps(spark):
    got = rules.recommendations(listings(spark)).collect()
    assert [r.recommendation_id for r in got] == list(range(1, len(got) + 1))
    assert got[0].theme == "Host Strategy" and len(got[0]) == 8


def test_summary_falls_back_without_recommendations(spark):
    text = rules.executive_summary(listings(spark).limit(0)).first().summary
    assert "**0** listings" in text and "**N/A**" in text and text.endswith("risk is concentrated.")


def test_market_view_filters_and_falls_back(spark):
    df = listings(spark)
    assert dashboard.market_view(df).count() == 400
    narrow = dashboard.market_view(df, rooms=["Private room"], price_range=(100, 101), professional=False)
    assert {r.price for r in narrow.collect()} == {100.0, 101.0}
    assert dashboard.market_view(df, areas=["nowhere"]).count() == 400


def test_price_bounds_default(spark):
    assert tuple(dashboard.price_bounds(listings(spark).where("price IS NULL")).first()) == (0, 10000)


def test_best_and_boosted_models(spark):
    results = spark.createDataFrame([("Linear", "0.7"), ("XGBoost", "0.98"), ("Broken", "n/a")], "model string, r2_score string")
    assert dashboard.best_model(results).first().model == "XGBoost"
    assert [r.model for r in dashboard.boosted_rows(results, "xgb").collect()] == ["XGBoost"]


@pytest.mark.parametrize("columns", [["id", "price", "room_type"], ["id", "price", "room_type", "is_professional_host"]])
def test_insights_report_absent_columns(spark, columns):
    got = {r.chart_name: r.finding for r in eda.eda_insights(listings(spark).select(*columns)).collect()}
    assert len(got) == 7 and got["top_neighbourhoods_price"] == "Column not found"
    assert (got["professional_vs_casual"] == "Column not found") == ("is_professional_host" not in columns)


def test_views_work_whatever_the_columns_are_called(spark):
    df = spark.createDataFrame(
        [(1, "A", "Flat", 10.0, 4.0, 20, "t"), (2, "A", "Flat", 30.0, 5.0, 30, "f"), (3, None, "Room", None, None, 0, None)],
        "listing_id long, neighborhood string, stay_type string, nightly_price double, avg_review_score double, reviews_count int, professional_host string",
    )
    view = dashboard.one_shape(df)
    assert view.columns[0] == "id" and "neighbourhood_cleansed" in view.columns and view.count() == 3
    matrix = [tuple(r) for r in dashboard.neighbourhood_matrix(view).collect()]
    assert matrix == [("A", 20.0, 2), (None, None, 0)]
    assert {(r["filter"], r.option) for r in dashboard.filter_options(view).collect()} >= {("room_type", "Flat"), ("neighbourhood", "A")}
    assert {r.host_segment: r.listing_count for r in dashboard.host_segments(view).collect()} == {"Professional": 1, "Casual": 2}
    assert [r.id for r in dashboard.improvement_targets(view).collect()] == [1]
    assert dashboard.map_points(view).collect() == []  # no places at all
    assert dashboard.market_filter(view, rooms=["Room"]).count() == 1
    with pytest.raises(ValueError, match="no price column"):
        dashboard.known_days(spark.range(1))


def test_computed_columns_are_not_shuffled(spark):
    """Columns that finish adds are computed after the joins: no exchange carries them."""
    listings = spark.range(5).withColumn("base", F.col("id") * 2)
    calendar = spark.createDataFrame([(1, True, 2.0)], "listing_id long, available boolean, price double")
    reviews = spark.createDataFrame([(1, 7, None)], "listing_id long, id long, date date")
    found = enrich.enrich_listings(listings, calendar.hint("merge"), reviews.hint("merge"), finish=lambda df: df.withColumns({"double_base": F.col("base") * 2}))
    rows = {r.id: r for r in found.collect()}
    assert rows[3].double_base == 12 and rows[1].calendar_days_total == 1 and rows[1].total_review_count == 1
    assert rows[0].total_review_count is None


def test_enriched_listings_are_joined_before_they_widen(spark):
    """The rows that the enrichment shuffles have no more columns than the listings are computed from."""
    from nestmetrics.catalog.tables import Market

    m = Market(spark, "/root/testdata/sf0.001")
    plan = m.enrich()._jdf.queryExecution().optimizedPlan().toString()
    joins = plan.index("Join LeftOuter")
    assert "AS description" in plan[:joins] and "AS description" not in plan[joins:]
    assert len(m._listing_sources.columns) < 10 < len(m.listings.columns)


def test_settings_hold_inside_only(spark):
    from nestmetrics.session import settings

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with settings(spark, {key: "7"}):
        assert spark.conf.get(key) == "7"
    assert spark.conf.get(key) == before
