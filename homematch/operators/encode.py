"""Flags, codes, scaling and engineered features."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from homematch import schemas
from homematch.functions import arrays, dates, numbers, text
from homematch.lookups import LOCATION_CLASSES, PROPERTY_CLASSES, SHIRES, type_column
from homematch.operators.joins import average_buyer, join_statistics, with_row

CALENDAR = ["year", "month", "day_of_week"]


def _flag(test: Column) -> Column:
    return F.coalesce(test, F.lit(False)).cast("int")


def type_flags(kind: Column) -> dict[str, Column]:
    """One 0/1 column per property class; what fits none is Other."""
    known = F.when(kind == "Flat", "Flat/Maisonette").when(kind.isin(PROPERTY_CLASSES), kind).otherwise("Other")
    return {type_column(name): (known == name).cast("int") for name in PROPERTY_CLASSES}


def county_flags(county: Column, names: Sequence[str] = tuple(SHIRES)) -> dict[str, Column]:
    """One 0/1 column per county; a missing county sets none."""
    return {f"county_{name}": _flag(county == name) for name in names}


def county_names(df: DataFrame, column: str = "county") -> list[str]:
    """County names that occur, for flags by data instead of the fixed six; they become columns, so all of them are needed."""
    return sorted(r[0] for r in df.where(F.col(column).isNotNull()).select(column).distinct().collect())


def location_flags(latitude: Column, longitude: Column, county: Column) -> dict[str, Column]:
    """Urban, Suburban and Rural flags; none where the county or place is unknown."""
    found = numbers.location_class(numbers.centre_distance(latitude, longitude, county))
    return {f"location_{name}": _flag(found == name) for name in LOCATION_CLASSES}


def with_location_columns(df: DataFrame) -> DataFrame:
    """Add location flags as 0 where the frame has none."""
    absent = {c: F.lit(0) for c in schemas.LOCATION_FLAGS if c not in df.columns}
    return df.withColumns(absent) if absent else df


def with_county(df: DataFrame) -> DataFrame:
    """County column, taken from the district where absent, else Unknown."""
    if "county" in df.columns:
        return df
    source = F.col("district") if "district" in df.columns else F.lit(None).cast("string")
    return df.withColumn("county", F.coalesce(source, F.lit("Unknown")))


def relative_price(df: DataFrame, price: str = "price", county: str = "county", result: str = "price_relative_to_county_avg") -> DataFrame:
    """Price over the mean price of the county, null without a county.

    Sums per county are taken before the shuffle and joined back, so that a
    county with most of the rows stays spread over all tasks.
    """
    means = df.where(F.col(county).isNotNull()).groupBy(county).agg(F.avg(price).alias("_mean"))
    joined = join_statistics(df, means, [county])
    return joined.withColumn(result, numbers.ratio(F.col(price), F.col("_mean"))).drop("_mean")


def engineer(df: DataFrame, as_of: dt.date, counties: Sequence[str] = tuple(SHIRES)) -> DataFrame:
    """Calendar, recency, energy, amenity, location, county and relative-price columns."""
    days = dates.days_since(F.col("date"), as_of)
    built = with_county(df).withColumns({
        **dates.calendar_parts(F.col("date")),
        "days_since_date": days,
        "listing_recency": dates.recency_class(days),
        "epc_rating": F.coalesce("epc_rating", F.lit("Unknown")),
        "epc_rating_encoded": text.epc_code(F.col("epc_rating")),
        "has_garden": _flag(arrays.mentions(F.col("features"), "garden")),
        "has_parking": _flag(arrays.mentions(F.col("features"), "parking")),
        "bedrooms": numbers.number_or_null(F.col("bedrooms")),
        "bathrooms": numbers.number_or_null(F.col("bathrooms")),
        **location_flags(F.col("latitude"), F.col("longitude"), F.col("county")),
        **county_flags(F.col("county"), counties),
    })
    return relative_price(built)


def affordability(df: DataFrame, users: DataFrame) -> DataFrame:
    """Price against the average buyer; the averages are one value, not a join."""
    held = with_row(df, average_buyer(users), "_buyer")
    return held.withColumns(numbers.average_ratios(F.col("price"), F.col("_buyer.avg_income"), F.col("_buyer.avg_savings"))).drop("_buyer")


def encode(df: DataFrame) -> DataFrame:
    """Property-class flags, location flags and the tenure code."""
    coded = with_location_columns(df).withColumns(type_flags(F.col("property_type")))
    return coded.withColumn("tenure", text.tenure_code(F.col("tenure")))


def fit_scaler(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation of each column, one row."""
    means = [F.avg(F.col(c).cast("double")).alias(f"{c}_mean") for c in columns]
    deviations = [F.stddev_pop(F.col(c).cast("double")).alias(f"{c}_std") for c in columns]
    return df.agg(*means, *deviations)


def scale(df: DataFrame, scaler: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Columns less their mean over their deviation; a constant column becomes 0.

    The scaler is one row of numbers, read before the columns are built.
    """
    held = scaler.first()

    def scaled(c: str) -> Column:
        gap = F.col(c).cast("double") - F.lit(held[f"{c}_mean"]).cast("double")
        if held[f"{c}_std"] == 0:
            return F.when(gap.isNotNull(), F.lit(0.0))
        return gap / F.lit(held[f"{c}_std"]).cast("double")

    return df.withColumns({f"{c}{suffix}": scaled(c) for c in columns})


def scale_calendar(df: DataFrame) -> DataFrame:
    """Calendar columns scaled over the whole table."""
    return scale(df, fit_scaler(df, CALENDAR), CALENDAR)


def processed_columns(df: DataFrame) -> DataFrame:
    """Stored features in order, followed by the county flags."""
    counties = [c for c in df.columns if c.startswith("county_")]
    return df.select(*schemas.PROCESSED_COLUMNS, *counties)


def stored_types(df: DataFrame) -> DataFrame:
    """Stored form of processed rows; whole-number columns drop their fraction toward zero."""
    doubles = ["price", "size_sq_ft", "price_to_income_ratio", "price_to_savings_ratio", "affordability_score",
               "latitude", "longitude", "price_relative_to_county_avg"]
    whole = ["year", "month", "day_of_week", "epc_rating_encoded", "bedrooms", "bathrooms"]
    counties = [c for c in df.columns if c.startswith("county_")]
    flags = [*schemas.FLAGS, *counties]
    kept = [F.col("id").cast("bigint").alias("original_id")]
    for name in [c for c in schemas.PROCESSED_COLUMNS if c != "id"] + counties:
        if name in doubles:
            kept.append(F.col(name).cast("double").alias(name))
        elif name in whole:
            kept.append(F.col(name).cast("double").cast("int").alias(name))
        elif name in flags:
            kept.append(F.coalesce(F.col(name).cast("boolean"), F.lit(False)).alias(name))
        else:
            kept.append(F.coalesce(F.col(name).cast("int"), F.lit(2)).alias(name))
    return df.select(*kept)
