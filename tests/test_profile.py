import datetime

from nestmetrics.plans import profile


def test_wide_tables_are_dealt_a_few_columns_at_a_time(spark):
    """One generated method for all columns of a wide table is not compiled; each part keeps its own columns."""
    wide = spark.range(50).selectExpr(*[f"id % {i + 1} AS c{i}" for i in range(40)])
    report = profile.profile_table(wide, "wide", "wide.csv")
    assert report._jdf.queryExecution().optimizedPlan().toString().count("Generate inline") >= 41 // profile.DEALT
    rows = report.collect()
    assert [(r["column_name"], r["unique_count"], r["row_count"], r["max_value"]) for r in rows] == [(f"c{i}", i + 1, 50, str(i)) for i in range(40)]
    assert {r["duplicate_rows"] for r in rows} == {0}


def test_values_are_told_apart_in_their_types(spark):
    day, second = datetime.date(2001, 1, 1), datetime.datetime(2001, 1, 1, 0, 0, 1)
    values = [
        (0, 0.0, True, day, second, "", b"", [1]),
        (1, -0.0, False, day, second, "0", b"0", [1, 2]),
        (-1, float("nan"), None, None, None, None, None, None),
        (0, 1e-300, True, datetime.date(1, 1, 1), datetime.datetime(2001, 1, 1, 0, 0, 1, 1), "null", b"\xff", []),
        (2**62, float("inf"), True, day, second, " ", b"0", [1]),
        (0, 0.0, True, day, second, "", b"", [1]),
    ]
    frame = spark.createDataFrame(values, "i long, d double, b boolean, day date, t timestamp_ntz, s string, raw binary, list array<int>")
    rows = {r["column_name"]: r for r in profile.profile_table(frame, "t", "t.csv").collect()}
    assert {c: r["unique_count"] for c, r in rows.items()} == {"i": 4, "d": 3, "b": 2, "day": 2, "t": 2, "s": 4, "raw": 3, "list": 3}
    assert {c: r["missing_count"] for c, r in rows.items()} == {"i": 0} | dict.fromkeys(["d", "b", "day", "t", "s", "raw", "list"], 1)
    assert {r["duplicate_rows"] for r in rows.values()} == {1} and rows["i"]["min_value"] == "-1"
