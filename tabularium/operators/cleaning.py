"""Row and column cleaning for tabular data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabularium.functions.columns import null_where

# Postal codes that were typed with a digit missing, and what they stand for.
CODE_REPAIRS = {"2804": "28004", "2805": "28005", "2815": "28015"}
NO_CODE = ("", "-", "28")
CODE_PREFIX = "28"


def range_cutoffs(
    df: DataFrame, cutoffs: list[tuple[str, float, float]], inclusive: bool = False
) -> DataFrame:
    """Rows inside every ``(column, low, high)``; strict bounds unless ``inclusive``."""

    def inside(column: str, low: float, high: float) -> Column:
        c = F.col(column)
        return c.between(low, high) if inclusive else (c > low) & (c < high)

    return df.filter(reduce(lambda a, b: a & b, [inside(*c) for c in cutoffs]))


def all_equal(df: DataFrame, wanted: dict[str, object]) -> DataFrame:
    """Rows matching every ``column: value``."""
    return df.filter(reduce(lambda a, b: a & b, [F.col(k) == v for k, v in wanted.items()]))


def members(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(F.col(column).isin(values))


def row_by_key(df: DataFrame, key: str, value) -> DataFrame:
    return df.filter(F.col(key) == value)


def non_empty(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column) != "")


def differing(df: DataFrame, left: str, right: str, nulls_differ: bool = False) -> DataFrame:
    """Rows where two columns disagree; with ``nulls_differ`` a NULL on one side counts."""
    same = F.col(left).eqNullSafe(F.col(right)) if nulls_differ else F.col(left) == F.col(right)
    return df.filter(~same)


def complete_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=columns)


def nullify(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """``column: condition`` pairs; the column becomes NULL where the condition holds."""
    return df.withColumns({c: null_where(c, condition) for c, condition in rules.items()})


def recode(df: DataFrame, column: str, mapping: dict) -> DataFrame:
    value = F.col(column)
    for old, new in mapping.items():
        value = F.when(F.col(column) == F.lit(old), F.lit(new)).otherwise(value)
    return df.withColumn(column, value.cast(df.schema[column].dataType))


def rename_all(df: DataFrame, names: list[str]) -> DataFrame:
    return df.toDF(*names)


def repaired_code(code: Column | str) -> Column:
    """Placeholder values give NULL, the first line counts, short codes are completed."""
    raw = F.col(code) if isinstance(code, str) else code
    first = F.trim(F.split(raw, "\n")[0])
    value = first
    for typed, meant in CODE_REPAIRS.items():
        value = F.when(first == typed, F.lit(meant)).otherwise(value)
    usable = ~first.isin(*NO_CODE) & first.startswith(CODE_PREFIX)
    return F.when(usable, value)


def repair_codes(
    df: DataFrame, code: str, corrections: DataFrame | None = None, key: str = "id"
) -> DataFrame:
    """Rule-based repair, then single corrections ``(key, code)`` for the rows that need one.

    The correction table is a plain left join: Spark broadcasts it while it is small.
    """
    fixed = df.withColumn(code, repaired_code(code))
    if corrections is None:
        return fixed
    patch = corrections.select(key, F.col(code).alias("_patch")).dropDuplicates([key])
    return (
        fixed.join(patch, key, "left")
        .withColumn(code, F.coalesce("_patch", code))
        .drop("_patch")
    )


def interactions(df: DataFrame, bedrooms: str, bathrooms: str, lat: str, lon: str) -> DataFrame:
    return df.withColumns(
        {
            "bedrooms_squared": F.col(bedrooms) * F.col(bedrooms),
            "bed_bath_rooms": F.col(bedrooms) * F.col(bathrooms),
            "lat_times_lon": F.col(lat) * F.col(lon),
        }
    )


def shape_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, row count and non-NULL count, in a single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count(F.col(c)).alias(f"_n{i}") for i, c in enumerate(df.columns)],
    )
    described = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(t).alias("type"),
            F.col("_rows").alias("rows"),
            F.col(f"_n{i}").alias("non_null"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*described)))


def null_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    """Share of NULL rows, and of zeros among the other rows, per column, in one pass."""
    parts = []
    for i, c in enumerate(columns):
        parts += [
            F.count(F.col(c)).alias(f"_n{i}"),
            F.count_if(F.col(c) == 0).alias(f"_z{i}"),
        ]
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *parts)
    described = [
        F.struct(
            F.lit(c).alias("column"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("nulls"),
            F.try_divide((F.col("_rows") - F.col(f"_n{i}")) * 100.0, F.col("_rows")).alias(
                "null_percent"
            ),
            F.try_divide(F.col(f"_z{i}") * 100.0, F.col(f"_n{i}")).alias("zero_percent"),
        )
        for i, c in enumerate(columns)
    ]
    return counts.select(F.inline(F.array(*described)))
