"""Row filters and column choices."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from homematch.functions.dates import in_year
from homematch.functions.text import cleansed_county


def shires_in_year(df: DataFrame, county: str, date: str, targets: Sequence[str], year: int) -> DataFrame:
    """Rows of the target shires in one year, with the county cleansed.

    Targets pass through the same cleansing, so that West Berkshire keeps Berkshire.
    """
    names = [t.upper() for t in targets]
    names = [n.split(" ", 1)[1] if n.startswith(("NORTH ", "WEST ")) else n for n in names]
    cleansed = df.withColumn(county, cleansed_county(F.col(county)))
    return cleansed.where(F.col(county).isin(names) & in_year(F.col(date), year))


def with_price(df: DataFrame, price: str = "price") -> DataFrame:
    return df.where(F.col(price).isNotNull())


def without_coordinates(df: DataFrame) -> DataFrame:
    """Rows lacking a latitude or a longitude."""
    return df.where(F.col("latitude").isNull() | F.col("longitude").isNull())


def profile_mask(columns: Sequence[str], profile: dict) -> Column:
    """Hard preferences of one buyer as a predicate over property columns.

    A preference without a matching column is ignored.
    """
    mask = F.col("price") <= profile["income"] * 4 + profile["savings"]
    wanted = [
        f"county_{str(profile.get('preferred_county')).lower()}",
        f"location_{profile.get('preferred_location')}",
        f"property_type_{profile.get('desired_property_type')}",
    ]
    wanted += [f"has_{name.lower()}" for name in profile.get("must_have_features") or [] if name.lower() in ("garden", "parking")]
    for column in wanted:
        if column in columns:
            mask = mask & (F.col(column).cast("int") == 1)
    return mask


def above_threshold(df: DataFrame, probability: str, threshold: float = 0.5) -> DataFrame:
    return df.where(F.col(probability) > threshold)


def columns_with_prefix(df: DataFrame, prefix: str = "county_") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def with_missing_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Add absent columns filled with 0."""
    absent = {c: F.lit(0) for c in expected if c not in df.columns}
    return df.withColumns(absent) if absent else df


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    """Text and list columns, the ones a generic frame holds as objects."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.ArrayType))]


def first_rows(df: DataFrame, key: str, n: int | None) -> DataFrame:
    """At most ``n`` rows in key order, the whole frame without a limit."""
    return df if n is None else df.orderBy(key).limit(n)


def require_rows(**frames: DataFrame) -> None:
    """Stop a job whose inputs hold no rows."""
    for name, frame in frames.items():
        if frame.isEmpty():
            raise ValueError(f"{name} holds no rows")
