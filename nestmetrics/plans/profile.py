"""Per-column profile of a table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestmetrics.functions.exprs import parse_date_lenient

# Name parts that mark a text column as a date.
DATE_WORDS = ("date", "since", "last_review", "first_review", "created", "updated")


def is_date_like(name: str) -> bool:
    return any(word in name.lower() for word in DATE_WORDS)


#: Columns dealt out in one scan, which reads no others. More make one generated method that the JIT refuses to compile.
DEALT = 6
#: What a row's own digest is counted under, next to its cells' under their columns' numbers.
_ROW = -1


def _hashable(field: T.StructField) -> Column:
    """The value as the hash functions take it: composed values as text, the two zeros as one."""
    value = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.MapType, T.ArrayType, T.StructType, T.VariantType)):
        return F.to_json(value)
    return (value + F.lit(0.0)).cast(field.dataType) if _is_float(field) else value


def _is_float(field: T.StructField) -> bool:
    return isinstance(field.dataType, (T.DoubleType, T.FloatType))


def digest(*values: Column) -> tuple[Column, Column]:
    """128 bits of some values, as two hashes of 64 from different starts. Nulls take no part: hash their places too."""
    return F.xxhash64(F.lit(1), *values), F.xxhash64(F.lit(2), *values)


def row_digest(df: DataFrame) -> tuple[Column, Column]:
    """128 bits of a whole row, equal for rows that are equal in every column, nulls included."""
    values = [_hashable(f) for f in df.schema.fields]
    return digest(F.array(F.lit(True), *[v.isNull() for v in values]), *values)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """One row: how many rows repeat an earlier one in every column. Only digests of rows are shuffled."""
    first, second = row_digest(df)
    copies = df.select(first.alias("_d1"), second.alias("_d2")).groupBy("_d1", "_d2").agg(F.count(F.lit(1)).alias("_n"))
    return copies.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_rows"))


def _known(field: T.StructField) -> Column:
    """The value, null where a number is not one."""
    value = _hashable(field)
    return F.when(~F.isnan(value), value) if _is_float(field) else value


#: Types of at most 64 bits, which one hash of 64 tells apart: it only shuffles their bits.
_SHORT = (
    T.BooleanType, T.IntegralType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType,
)


def cell_digest(field: T.StructField) -> tuple[Column, Column]:
    """Two numbers that tell a column's known values apart, null for others: a whole number itself, else hashes of the value in its type."""
    value = _known(field)
    if isinstance(field.dataType, T.IntegralType):
        return value.cast("long"), F.lit(0).cast("long")
    first, second = digest(value)
    if isinstance(field.dataType, _SHORT):
        second = F.lit(0).cast("long")
    return F.when(value.isNotNull(), first), second


def _extent(field: T.StructField) -> tuple[str, Column, T.DataType] | None:
    """How a column's range is carried: under which name, the value, and the type that it is shown as."""
    dtype = field.dataType
    if isinstance(dtype, T.IntegralType):
        return "long", _known(field).cast("long"), dtype
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return "double", _known(field).cast("double"), dtype
    if isinstance(dtype, T.DecimalType):
        return f"decimal_{dtype.scale}", _known(field).cast(T.DecimalType(38, dtype.scale)), dtype
    if is_date_like(field.name) and isinstance(dtype, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "long", F.unix_date(parse_date_lenient(_known(field), dtype)).cast("long"), T.DateType()
    return None


def _shown(label: str, extents: list) -> Column:
    """The lowest or highest value as text, in the type of the column that a row of figures is about."""
    kinds: dict[tuple[str, str], list[int]] = {}
    for i, extent in enumerate(extents):
        if extent:
            kinds.setdefault((extent[0], "long" if isinstance(extent[2], T.IntegralType) else extent[2].simpleString()), []).append(i)
    text = F.lit(None).cast("string")
    for (name, dtype), numbers in kinds.items():
        value = F.col(f"{label}_{name}")
        typed = F.date_from_unix_date(value.cast("int")) if dtype == "date" else value.cast(dtype)
        text = F.when(F.col("_i").isin(numbers), typed.cast("string")).otherwise(text)
    return text


def _carrier_type(name: str) -> str:
    return f"decimal(38,{name.removeprefix('decimal_')})" if name.startswith("decimal_") else name


def profile_table(df: DataFrame, file_key: str, file_name: str) -> DataFrame:
    """One row per column: counts, share of nulls, distinct values, range of numbers and dates.

    Each row is dealt into the digests of its cells, with the value itself only where a range is asked for,
    and one of the whole row. Equal digests collapse before the shuffle, which holds no texts, and all
    figures are sums over the groups. A few columns are dealt out at a time, so wide tables take several scans, of their
    own columns each. No value is written out as text to be told apart. Ranges keep all digits: they
    are text, not floats.
    """
    fields = df.schema.fields
    extents = [_extent(f) for f in fields]
    # The ranges' carriers, in a fixed order: one for whole numbers and days, one for floats, one for each decimal scale.
    carried = sorted({extent[0] for extent in extents if extent})

    none = {name: F.lit(None).cast(_carrier_type(name)) for name in carried}

    def dealt(number: int, told: tuple[Column, Column], extent=None) -> Column:
        ranges = [(extent[1] if extent and extent[0] == name else none[name]).alias(f"_{name}") for name in carried]
        return F.struct(F.lit(number).alias("_i"), told[0].alias("_d1"), told[1].alias("_d2"), *ranges)

    cells = [dealt(_ROW, row_digest(df))]
    cells += [dealt(i, cell_digest(f), extent) for i, (f, extent) in enumerate(zip(fields, extents, strict=True))]
    parts = [df.select(F.inline(F.array(*cells[at : at + DEALT]))) for at in range(0, len(cells), DEALT)]
    groups = (
        reduce(DataFrame.unionAll, parts)
        .where("_d1 IS NOT NULL")
        .groupBy("_i", "_d1", "_d2")
        .agg(F.count(F.lit(1)).alias("_n"), *[F.min(f"_{name}").alias(f"_{name}") for name in carried])
    )
    figures = groups.groupBy("_i").agg(
        F.sum("_n").alias("rows"),
        F.count(F.lit(1)).alias("different"),
        *[side(f"_{name}").alias(f"{label}_{name}") for name in carried for label, side in (("low", F.min), ("high", F.max))],
    )
    shown = {label: _shown(label, extents).alias(f"{label}_value") for label in ("low", "high")}
    # One row for each column, gathered in one and looked up by each column.
    entry = F.struct("_i", F.struct("rows", "different", shown["low"], shown["high"]))
    found = figures.agg(F.map_from_entries(F.collect_list(entry)).alias("_found"))
    names = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("dtype"))
            for i, f in enumerate(fields)
        ]
    )

    def report(column: Column) -> Column:
        own, whole = F.try_element_at("_found", column["i"]), F.try_element_at("_found", F.lit(_ROW))
        rows = F.coalesce(whole["rows"], F.lit(0))
        return F.struct(
            column["name"].alias("column_name"),
            column["dtype"].alias("dtype"),
            rows.alias("row_count"),
            (rows - F.coalesce(own["rows"], F.lit(0))).alias("missing_count"),
            F.coalesce(own["different"], F.lit(0)).alias("unique_count"),
            (rows - F.coalesce(whole["different"], F.lit(0))).alias("duplicate_rows"),
            own["low_value"].alias("min_value"),
            own["high_value"].alias("max_value"),
        )

    per_column = found.select(F.inline(F.transform(names, report)))
    share = F.rint(F.col("missing_count") / F.col("row_count") * 100 * 100.0) / 100.0
    return per_column.select(
        F.lit(file_key).alias("file_key"),
        F.lit(file_name).alias("file_name"),
        "column_name",
        "dtype",
        "row_count",
        F.lit(len(fields)).cast("long").alias("column_count"),
        "missing_count",
        F.when(F.col("row_count") > 0, share).otherwise(0.0).alias("missing_pct"),
        "unique_count",
        "duplicate_rows",
        "min_value",
        "max_value",
    )


def profile_error(spark, file_key: str, file_name: str, message: str) -> DataFrame:
    """The row that stands for a table that could not be profiled."""
    schema = (
        "file_key string, file_name string, column_name string, dtype string, row_count long, "
        "column_count long, missing_count long, missing_pct double, unique_count long, "
        "duplicate_rows long, min_value string, max_value string"
    )
    row = (file_key, file_name, "ERROR", message, 0, 0, 0, 0.0, 0, 0, None, None)
    return spark.createDataFrame([row], schema)


def profile_tables(spark, tables: dict[str, tuple[str, DataFrame | Exception]]) -> DataFrame:
    """Profiles of several tables, one below the other.

    A table that failed to open is given as its exception and becomes an error row.
    """
    parts = [
        profile_error(spark, key, name, str(df)) if isinstance(df, Exception) else profile_table(df, key, name)
        for key, (name, df) in tables.items()
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
