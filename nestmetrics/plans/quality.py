"""Data-quality checks. All checks of one table are one aggregate over one scan."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmetrics.functions.exprs import parse_date_lenient


@dataclass(frozen=True)
class Check:
    kind: str  # not_null, no_duplicates, range, positive, boolean or valid_date
    column: str
    severity: str
    low: float | None = None
    high: float | None = None


@dataclass(frozen=True)
class _Rule:
    name: str
    missing_name: str
    failed: Column  # aggregate that counts the offending rows
    bad_status: str
    bad_note: tuple[str, str]  # text before and after the count
    good_note: str


def not_null(column: str, severity: str = "ERROR") -> Check:
    return Check("not_null", column, severity)


def no_duplicates(column: str, severity: str = "WARNING") -> Check:
    return Check("no_duplicates", column, severity)


def in_range(column: str, low: float, high: float, severity: str = "ERROR") -> Check:
    return Check("range", column, severity, low, high)


def positive(column: str, severity: str = "WARNING") -> Check:
    return Check("positive", column, severity)


def is_boolean(column: str, severity: str = "WARNING") -> Check:
    return Check("boolean", column, severity)


def valid_date(column: str, severity: str = "WARNING") -> Check:
    return Check("valid_date", column, severity)


# The standard checks of the three cleaned tables.
LISTING_CHECKS = (
    not_null("id", "ERROR"),
    no_duplicates("id", "ERROR"),
    positive("price", "WARNING"),
    in_range("latitude", -90, 90, "ERROR"),
    in_range("longitude", -180, 180, "ERROR"),
    in_range("availability_365", 0, 365, "WARNING"),
    not_null("room_type", "ERROR"),
)
CALENDAR_CHECKS = (
    not_null("listing_id", "ERROR"),
    valid_date("date", "ERROR"),
    is_boolean("available", "WARNING"),
)
REVIEW_CHECKS = (
    not_null("listing_id", "ERROR"),
    valid_date("date", "WARNING"),
)


def _null(c: Column, dtype: T.DataType | None) -> Column:
    return c.isNull() | F.isnan(c) if isinstance(dtype, (T.DoubleType, T.FloatType)) else c.isNull()


def _count(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def _rule(check: Check, dtype: T.DataType | None) -> _Rule:
    """Name, failure count and fixed report texts of one check."""
    name, c = check.column, F.col(check.column)
    null = _null(c, dtype)
    if check.kind == "not_null":
        label = f"{name}_not_null"
        return _Rule(label, label, _count(null), "FAIL", (f"{name} has ", " null values"), "All values present")
    if check.kind == "no_duplicates":
        # Nulls count as equal to each other.
        repeats = F.count(F.lit(1)) - F.countDistinct(F.when(~null, c)) - F.max(F.when(null, 1).otherwise(0))
        failed = F.coalesce(repeats, F.lit(0))
        label = f"{name}_no_duplicates"
        return _Rule(label, label, failed, "WARN", ("", f" duplicate {name} values"), "No duplicates")
    if check.kind == "range":
        low, high = check.low, check.high
        failed = _count(~null & ((c < low) | (c > high)))
        label, missing = f"{name}_in_range_[{low},{high}]", f"{name}_range_{low}_{high}"
        return _Rule(label, missing, failed, "FAIL", ("", f" values outside [{low}, {high}]"), "All in range")
    if check.kind == "positive":
        label, missing = f"{name}_greater_than_0", f"{name}_positive"
        return _Rule(label, missing, _count(~null & (c <= 0)), "WARN", ("", " values <= 0"), "All positive")
    if check.kind == "boolean":
        if isinstance(dtype, T.BooleanType):
            failed = F.count_if(F.lit(False))
        elif isinstance(dtype, T.NumericType):
            failed = _count(~null & ~c.isin(0, 1))
        else:
            failed = _count(~null)
        label = f"{name}_is_boolean"
        return _Rule(label, label, failed, "WARN", ("", " non-boolean values"), "All boolean")
    if check.kind == "valid_date":
        label = f"{name}_valid_date"
        failed = F.count_if(parse_date_lenient(c, dtype).isNull())
        return _Rule(label, label, failed, "WARN", ("", " invalid/missing dates"), "All dates valid")
    raise ValueError(f"unknown check {check.kind}")


def run_checks(df: DataFrame, table: str, checks: Sequence[Check]) -> DataFrame:
    """One report row per check. A missing column fails every row of the table."""
    aggregates, rows = [F.count(F.lit(1)).alias("_total")], []
    for i, check in enumerate(checks):
        present = check.column in df.columns
        rule = _rule(check, df.schema[check.column].dataType if present else None)
        failed = F.col("_total")
        if present:
            aggregates.append(rule.failed.cast("long").alias(f"_failed_{i}"))
            failed = F.col(f"_failed_{i}")
        if present or check.kind == "not_null":
            name = rule.name
            status = F.when(failed == 0, "PASS").otherwise(rule.bad_status)
            before, after = rule.bad_note
            counted = F.concat(F.lit(before), failed.cast("string"), F.lit(after))
            notes = F.when(failed > 0, counted).otherwise(rule.good_note)
        else:
            name, status = rule.missing_name, F.lit("FAIL")
            where = f" in {table}" if check.kind == "no_duplicates" else ""
            notes = F.lit(f"Column {check.column} not found{where}")
        rows.append(
            F.struct(
                F.lit(name).alias("check_name"),
                F.lit(table).alias("table_name"),
                status.alias("status"),
                failed.alias("failed_rows"),
                F.col("_total").alias("total_rows"),
                F.lit(check.severity).alias("severity"),
                notes.alias("notes"),
            )
        )
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def quality_report(
    listings: DataFrame | None = None, calendar: DataFrame | None = None, reviews: DataFrame | None = None
) -> DataFrame:
    """The standard checks of whichever tables exist."""
    parts = [
        run_checks(df, table, checks)
        for df, table, checks in (
            (listings, "listings", LISTING_CHECKS),
            (calendar, "calendar", CALENDAR_CHECKS),
            (reviews, "reviews", REVIEW_CHECKS),
        )
        if df is not None
    ]
    if not parts:
        nothing = SparkSession.active().range(0)
        return run_checks(nothing, "listings", LISTING_CHECKS[:1]).where(F.lit(False))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


def report_summary(report: DataFrame) -> DataFrame:
    """One row: passed checks, all checks, and the failed ones as sorted text."""
    failed = F.when(F.col("status") == "FAIL", F.concat_ws(".", "table_name", "check_name"))
    return report.agg(
        F.count_if(F.col("status") == "PASS").alias("passed"),
        F.count(F.lit(1)).alias("checks"),
        # A report has one row per check.
        F.concat_ws(", ", F.array_sort(F.collect_list(failed))).alias("failures"),
    )


def failed_checks(report: DataFrame) -> DataFrame:
    return report.where(F.upper(F.col("status").cast("string")) == "FAIL")


# ---------------------------------------------------------------- keys


def check_primary_key(df: DataFrame, column: str, table: str) -> DataFrame:
    return run_checks(df, table, [not_null(column, "ERROR"), no_duplicates(column, "ERROR")])


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str, label: str) -> DataFrame:
    """Rows whose key is set but has no parent, counted per key before the anti join.

    The sides are merged, not broadcast: stored keys take so few bytes that millions of them would count as small.
    """
    per_key = (
        child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    )
    orphans = per_key.join(parent.select(F.col(parent_column).alias("_k")).hint("merge"), "_k", "left_anti")
    return orphans.agg(
        F.lit(label).alias("check_name"),
        F.coalesce(F.sum("_n"), F.lit(0)).alias("orphan_rows"),
        F.count(F.lit(1)).alias("orphan_keys"),
    )


# ---------------------------------------------------------------- checks over the star schema


def star_check(df: DataFrame, name: str, failed: Column, checked: Column | None = None) -> DataFrame:
    """``check_name, total_rows, failed_rows`` over the rows that qualify."""
    rows = df if checked is None else df.where(checked)
    return rows.agg(
        F.lit(name).alias("check_name"),
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(F.when(failed, 1).otherwise(0)).alias("failed_rows"),
    )


def star_checks(df: DataFrame, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Several checks of one table from one aggregate over it: name, the failure, and which rows count."""
    counts = []
    for i, (_, failed, counted) in enumerate(checks):
        counts += [
            F.count_if(counted).alias(f"_total_{i}"),
            F.sum(F.when(counted, F.when(failed, 1).otherwise(0))).alias(f"_failed_{i}"),
        ]
    rows = [
        F.struct(F.lit(name).alias("check_name"), F.col(f"_total_{i}").alias("total_rows"), F.col(f"_failed_{i}").alias("failed_rows"))
        for i, (name, _, _) in enumerate(checks)
    ]
    return df.agg(*counts).select(F.inline(F.array(*rows)))


def star_null_checks(dim_listing: DataFrame, fact_calendar: DataFrame, fact_reviews: DataFrame) -> DataFrame:
    def null(name: str, column: str) -> tuple[str, Column, Column]:
        return name, F.col(column).isNull(), F.lit(True)

    listings = star_checks(dim_listing, [null("listing_id_null", "listing_id"), null("room_type_not_null", "room_type")])
    calendar = star_checks(
        fact_calendar, [null("calendar_listing_id_not_null", "listing_id"), null("calendar_date_valid", "date_key")]
    )
    reviews = star_checks(fact_reviews, [null("reviews_listing_id_not_null", "listing_id")])
    return listings.unionByName(calendar).unionByName(reviews)


def star_duplicate_check(dim_listing: DataFrame) -> DataFrame:
    """Here every null counts as a duplicate, unlike in ``no_duplicates``."""
    return dim_listing.agg(
        F.lit("duplicate_listing_ids").alias("check_name"),
        (F.count(F.lit(1)) - F.countDistinct("listing_id")).alias("duplicate_count"),
    )


def star_price_check(fact: DataFrame) -> DataFrame:
    return star_check(fact, "price_positive", (F.col("price") <= 0) | F.col("price").isNull())


def star_range_checks(dim_listing: DataFrame, fact: DataFrame) -> DataFrame:
    def outside(column: str, low: float, high: float) -> tuple[str, Column, Column]:
        value = F.col(column)
        return f"{column}_range", (value < low) | (value > high), value.isNotNull()

    places = star_checks(dim_listing, [outside("latitude", -90, 90), outside("longitude", -180, 180)])
    return places.unionByName(star_checks(fact, [outside("availability_365", 0, 365)]))
