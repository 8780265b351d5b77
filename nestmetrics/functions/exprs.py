"""Scalar column functions. All of them are native Spark expressions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted spellings of booleans.
TRUE_WORDS = ("t", "true", "1")
FALSE_WORDS = ("f", "false", "0")
LENIENT_TRUE_WORDS = ("true", "t", "1", "yes", "y")

# Weekdays counted from Monday = 0.
WEEKEND_SAT_SUN = (5, 6)
WEEKEND_FRI_SAT = (4, 5)

# Host tiers as (largest listing count in the tier, label); the last tier is open.
HOST_TIERS = (
    (1, "Solo Host"),
    (2, "Small Portfolio"),
    (9, "Mid Portfolio"),
    (None, "Commercial Operator"),
)
PROFESSIONAL_MIN_LISTINGS = 3

Cleaner = Callable[[Column, T.DataType], Column]


def strip_ws(c: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")


def finite(c: Column) -> Column:
    """Double value, or null where it is NaN or infinite."""
    c = c.cast("double")
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), None).otherwise(c)


def seeded_hash(key: Column, seed: int) -> Column:
    """60 bits of the MD5 of key and seed, as any engine computes them."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", key.cast("string"), F.lit(seed).cast("string"))), 1, 15), 16, 10).cast("long")


def round_half_even(c: Column, digits: int) -> Column:
    """Scale, round to the nearest even integer, scale back (how array libraries round)."""
    scale = float(10**digits)
    return F.rint(c.cast("double") * scale) / scale


# ---------------------------------------------------------------- cleaning


def clean_price(c: Column, dtype: T.DataType | None = None) -> Column:
    """``$1,234.56`` to 1234.56. Only digits and dots survive; what does not parse becomes null."""
    if isinstance(dtype, T.NumericType):
        return F.when(F.isnan(c.cast("double")), None).otherwise(c.cast("double"))
    return F.regexp_replace(c.cast("string"), r"[^0-9.]", "").try_cast("double")


def parse_bool(c: Column, dtype: T.DataType | None = None) -> Column:
    """Three-valued boolean from t/f, true/false, 1/0."""
    if isinstance(dtype, T.BooleanType):
        return c
    word = F.lower(strip_ws(c))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def parse_date_lenient(c: Column, dtype: T.DataType | None = None) -> Column:
    """Date from ISO or US text, null when it is neither. Date-time columns are truncated."""
    if isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return c.cast("date")
    text = strip_ws(c)
    return F.coalesce(text.try_cast("date"), F.try_to_date(text, "MM/dd/yyyy"))


def standardise_text(c: Column, dtype: T.DataType | None = None) -> Column:
    return strip_ws(c)


def conditional_fill(c: Column, condition: Column, value: float) -> Column:
    """Fill a null only where the condition holds."""
    return F.when(condition & c.isNull(), F.lit(value)).otherwise(c)


def apply_by_column(df: DataFrame, rules: Sequence[tuple[Callable[[str], bool], Cleaner]]) -> DataFrame:
    """Apply each cleaner to the columns its name test picks, all in one projection."""
    changed: dict[str, Column] = {}
    for field in df.schema.fields:
        for wanted, cleaner in rules:
            if wanted(field.name):
                changed[field.name] = cleaner(changed.get(field.name, F.col(field.name)), field.dataType)
    return df.withColumns(changed) if changed else df


# ---------------------------------------------------------------- schema helpers


def first_existing_col(df: DataFrame, candidates: Iterable[str]) -> str | None:
    return next((c for c in candidates if c in df.columns), None)


def existing_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [c for c in names if c in df.columns]


def project_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema in its order and types; the ones the frame lacks become null."""
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def rename_reorder(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Select source columns under new names, in the order of the mapping."""
    return df.select(*[F.col(src).alias(dst) for src, dst in mapping.items()])


# ---------------------------------------------------------------- booleans and numbers


def lenient_bool(c: Column) -> Column:
    """True for the accepted words; everything else, null included, is false."""
    return F.coalesce(F.lower(c.cast("string")).isin(*LENIENT_TRUE_WORDS), F.lit(False))


def to_binary(c: Column) -> Column:
    word = F.lower(strip_ws(c))
    return F.when(word.isin(*LENIENT_TRUE_WORDS), F.lit(1.0)).otherwise(F.lit(0.0))


def to_numeric(c: Column, dtype: T.DataType | None = None) -> Column:
    if isinstance(dtype, (T.NumericType, T.BooleanType)):
        return c.cast("double")
    return c.cast("string").try_cast("double")


def is_missing(c: Column) -> Column:
    """Null, NaN or infinite."""
    d = c.cast("double")
    return c.isNull() | F.isnan(d) | (F.abs(d) == F.lit(float("inf")))


def clip_upper(c: Column, limit: float) -> Column:
    return F.when(c > limit, F.lit(limit).cast("double")).otherwise(c.cast("double"))


def percent_difference(a: Column, b: Column) -> Column:
    """(a - b) / b x 100, and 0 when b is not positive."""
    return F.when(b > 0, (a - b) / b * 100).otherwise(F.lit(0.0))


def log_price(c: Column) -> Column:
    return finite(F.log1p(c.cast("double")))


def unlog_price(c: Column) -> Column:
    return finite(F.expm1(c.cast("double")))


# ---------------------------------------------------------------- derived listing fields


def host_tenure_years(host_since: Column, snapshot_date: str) -> Column:
    days = F.datediff(F.to_date(F.lit(snapshot_date)), host_since)
    return round_half_even(days / F.lit(365.25), 1)


def price_per_bedroom(price: Column, bedrooms: Column) -> Column:
    return F.when(bedrooms > 0, round_half_even(price / bedrooms, 2))


def professional_flag(listing_count: Column) -> Column:
    return F.coalesce(listing_count >= PROFESSIONAL_MIN_LISTINGS, F.lit(False))


def host_tier(listing_count: Column) -> Column:
    """Right-closed bins; a null count means one listing, a count of zero or less has no tier."""
    n = F.coalesce(listing_count.cast("double"), F.lit(1.0))
    tier = F.when(n <= 0, F.lit(None).cast("string"))
    for upper, label in HOST_TIERS:
        tier = tier.otherwise(label) if upper is None else tier.when(n <= upper, label)
    return tier


def occupancy_rate(unavailable: Column, total: Column) -> Column:
    return round_half_even(F.try_divide(unavailable.cast("double"), total.cast("double")), 4)


def revenue_proxy(average_price: Column, unavailable_days: Column) -> Column:
    return round_half_even(average_price * unavailable_days, 2)


# ---------------------------------------------------------------- dates


def date_key(d: Column) -> Column:
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def date_key_to_date(key: Column) -> Column:
    return F.try_to_date(key.cast("string"), "yyyyMMdd")


def weekend_flag(d: Column, days: Sequence[int] = WEEKEND_SAT_SUN) -> Column:
    """Whether the weekday is one of ``days``; a missing date is not a weekend."""
    return F.coalesce(F.weekday(d).isin(*days), F.lit(False))


def month_bucket(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def date_parts(d: Column) -> dict[str, Column]:
    """The calendar attributes of a day, keyed by their column names."""
    return {
        "date_key": date_key(d),
        "full_date": d,
        "year": F.year(d),
        "month": F.month(d),
        "day": F.dayofmonth(d),
        "day_of_week": F.weekday(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": weekend_flag(d, WEEKEND_SAT_SUN),
        "month_name": F.date_format(d, "MMMM"),
        "quarter": F.quarter(d),
    }


# ---------------------------------------------------------------- predicates


def contains_ci(c: Column, needle: str) -> Column:
    return F.coalesce(F.lower(c).contains(needle.lower()), F.lit(False))


def all_of(conditions: Sequence[Column]) -> Column:
    """Conjunction of the conditions; none at all means true."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


# ---------------------------------------------------------------- text of numbers


def number_text(c: Column, pattern: str) -> Column:
    """Decimal pattern formatting, ties to even on the exact binary value."""
    return F.call_function("format_number", c.cast("double"), F.lit(pattern))


def whole(c: Column) -> Column:
    return number_text(c, "#,##0")


def one_decimal(c: Column) -> Column:
    return number_text(c, "0.0")


def two_decimals(c: Column) -> Column:
    return number_text(c, "0.00")


def signed_one_decimal(c: Column) -> Column:
    return number_text(c, "+0.0;-0.0")


def percent_text(c: Column, pattern: str = "0.0") -> Column:
    return F.concat(number_text(c.cast("double") * 100, pattern), F.lit("%"))


def or_na(c: Column, text: Column) -> Column:
    return F.when(is_missing(c), F.lit("N/A")).otherwise(text)


def format_currency(c: Column, symbol: str = "฿") -> Column:
    return or_na(c, F.concat(F.lit(symbol), whole(c)))


def format_number(c: Column) -> Column:
    return or_na(c, whole(c))


def format_percent(c: Column) -> Column:
    return or_na(c, percent_text(c))
