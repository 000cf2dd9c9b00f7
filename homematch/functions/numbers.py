"""Number expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from homematch.lookups import LOCATION_CLASSES, TOWN_CENTRES


def number_or_null(value: Column) -> Column:
    """Number in a text, null for anything else; NaN counts as missing."""
    text = F.trim(value.cast("string"))
    number = F.when(text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), text.try_cast("double"))
    return F.nanvl(number, F.lit(None).cast("double"))


def ratio(top: Column, bottom: Column) -> Column:
    """Quotient, null when the divisor is 0."""
    return F.try_divide(top, bottom)


def pair_ratios(price: Column, income: Column, savings: Column) -> dict[str, Column]:
    """Affordability of a price for one buyer, guarded by one in each divisor."""
    return {
        "price_to_income_ratio": price / (income + 1),
        "price_to_savings_ratio": price / (savings + 1),
        "affordability_score": (income * 4 + savings) / (price + 1),
    }


def average_ratios(price: Column, income: Column, savings: Column) -> dict[str, Column]:
    """Affordability of a price against average income and savings."""
    return {
        "price_to_income_ratio": ratio(price, income),
        "price_to_savings_ratio": ratio(price, savings),
        "affordability_score": ratio(income * 4 + savings, price),
    }


def centre_distance(latitude: Column, longitude: Column, county: Column) -> Column:
    """Distance in degrees to the closest town centre of the county.

    The centres are literals chosen per county, so no join is needed.
    """
    distance = None
    for shire, centres in TOWN_CENTRES.items():
        gaps = [F.sqrt(F.pow(F.lit(lat) - latitude, F.lit(2)) + F.pow(F.lit(lon) - longitude, F.lit(2)))
                for _, lat, lon in centres]
        closest = F.least(*gaps)
        here = F.lower(county) == shire
        distance = F.when(here, closest) if distance is None else distance.when(here, closest)
    return F.when(latitude.isNotNull() & longitude.isNotNull(), distance)


def location_class(distance: Column) -> Column:
    """Urban under 0.05 degrees, Suburban under 0.1, else Rural; null if unknown."""
    urban, suburban, rural = LOCATION_CLASSES
    return F.when(distance < 0.05, urban).when(distance < 0.1, suburban).when(distance >= 0.1, rural)


def price_segment(price: Column, segment_size: int) -> Column:
    """Number of the price segment, where each one starts one above the last.

    Segment 0 is 0 to ``size`` and segment n starts at n * (size + 1).
    """
    return F.floor(price / F.lit(segment_size + 1)).cast("bigint")


def price_segments(max_price: Column, segment_size: int) -> Column:
    """Array of (segment, min_price, max_price) covering prices up to a maximum."""
    step = segment_size + 1
    last = F.floor((max_price - 1) / F.lit(step)).cast("bigint")
    numbers = F.when(max_price > 0, F.sequence(F.lit(0).cast("bigint"), last)).otherwise(F.array().cast("array<bigint>"))
    return F.transform(
        numbers,
        lambda n: F.struct(
            n.alias("segment"),
            (n * step).alias("min_price"),
            F.least(n * step + segment_size, max_price.cast("bigint")).alias("max_price"),
        ),
    )


def confidence(probability: Column) -> Column:
    """Distance of a probability from one half."""
    return F.abs(probability - 0.5)
