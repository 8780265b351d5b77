"""Quality checks on small frames."""

import pytest

from nestmetrics.plans import quality as Q


def one(spark, ddl, values, check, table="t"):
    df = spark.createDataFrame([(v,) for v in values], ddl)
    return Q.run_checks(df, table, [check]).first()


CASES = [
    ("id long", [1, 2, 3], Q.not_null("id"), "PASS", 0),
    ("id long", [1, None, 3], Q.not_null("id"), "FAIL", 1),
    ("id long", [None] * 3, Q.not_null("id"), "FAIL", 3),
    ("x long", [1, 2], Q.not_null("id"), "FAIL", 2),
    ("x long", [], Q.not_null("id"), "PASS", 0),
    ("id long", [1, 2, 3], Q.no_duplicates("id"), "PASS", 0),
    ("id long", [1, 2, 2, 3], Q.no_duplicates("id"), "WARN", 1),
    ("id long", [1, None, None, None], Q.no_duplicates("id"), "WARN", 2),
    ("id long", [], Q.no_duplicates("id"), "PASS", 0),
    ("x long", [1, 2], Q.no_duplicates("id"), "FAIL", 2),
    ("lat double", [13.7, 13.8, 13.9], Q.in_range("lat", -90, 90), "PASS", 0),
    ("lat double", [13.7, 100.0, 13.9], Q.in_range("lat", -90, 90), "FAIL", 1),
    ("lat double", [13.7, None, 90.0], Q.in_range("lat", -90, 90), "PASS", 0),
    ("x double", [1.0], Q.in_range("lat", -90, 90), "FAIL", 1),
    ("price double", [100.0, 200.0], Q.positive("price"), "PASS", 0),
    ("price double", [100.0, 0.0, 300.0], Q.positive("price"), "WARN", 1),
    ("price double", [100.0, -50.0, None], Q.positive("price"), "WARN", 1),
    ("available boolean", [True, False, True], Q.is_boolean("available"), "PASS", 0),
    ("available boolean", [True, None, False], Q.is_boolean("available"), "PASS", 0),
    ("available int", [1, 0, 2, None], Q.is_boolean("available"), "WARN", 1),
    ("available string", ["t", None], Q.is_boolean("available"), "WARN", 1),
    ("date string", ["2023-01-15", "2023-02-01"], Q.valid_date("date"), "PASS", 0),
    ("date string", ["2023-01-15", "bad"], Q.valid_date("date"), "WARN", 1),
    ("date string", ["2023-01-15", None], Q.valid_date("date"), "WARN", 1),
    ("x string", ["a"], Q.valid_date("date"), "FAIL", 1),
]


@pytest.mark.parametrize("ddl,values,check,status,failed", CASES)
def test_status_and_failures(spark, ddl, values, check, status, failed):
    row = one(spark, ddl, values, check)
    assert (row.status, row.failed_rows, row.total_rows) == (status, failed, len(values))


def test_names_and_notes(spark):
    row = one(spark, "lat double", [1.0, 99.0], Q.in_range("lat", -90, 90, "WARNING"), "places")
    assert row.asDict() == {
        "check_name": "lat_in_range_[-90,90]", "table_name": "places", "status": "FAIL", "failed_rows": 1,
        "total_rows": 2, "severity": "WARNING", "notes": "1 values outside [-90, 90]",
    }
    assert one(spark, "x double", [1.0], Q.in_range("lat", -90, 90)).check_name == "lat_range_-90_90"
    assert one(spark, "x double", [1.0], Q.positive("price")).check_name == "price_positive"
    assert one(spark, "x double", [1.0], Q.no_duplicates("id"), "places").notes == "Column id not found in places"
    assert one(spark, "id long", [1, 1], Q.no_duplicates("id")).notes == "1 duplicate id values"


def test_all_checks_of_a_table_are_one_scan(spark):
    df = spark.range(5).selectExpr("id", "double(id) AS price", "string(id) AS room_type")
    plan = Q.run_checks(df, "listings", Q.LISTING_CHECKS)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 1


def test_report_of_absent_tables(spark):
    df = spark.range(3).selectExpr("id AS listing_id", "date'2024-01-01' AS date")
    report = Q.quality_report(reviews=df)
    assert [r.check_name for r in report.collect()] == ["listing_id_not_null", "date_valid_date"]
    summary = Q.report_summary(report).first()
    assert (summary.passed, summary.checks, summary.failures) == (2, 2, "")
    nothing = Q.quality_report()
    assert nothing.columns == report.columns and nothing.count() == 0


def test_foreign_keys_ignore_nulls(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "k long")
    assert tuple(Q.check_foreign_key(child, "k", parent, "k", "c.k").first()) == ("c.k", 2, 1)


def test_star_duplicates_count_every_null(spark):
    df = spark.createDataFrame([(1,), (None,), (None,)], "listing_id long")
    assert Q.star_duplicate_check(df).first().duplicate_count == 2
    assert one(spark, "listing_id long", [1, None, None], Q.no_duplicates("listing_id")).failed_rows == 1


def test_parents_of_a_foreign_key_are_not_broadcast(spark):
    """Their bytes say little about their number."""
    child, parent = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long"), spark.range(2).toDF("k")
    orphans = Q.check_foreign_key(child, "k", parent, "k", "c.k")
    assert tuple(orphans.first()) == ("c.k", 2, 1)
    plan = orphans._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
