"""Synthetic buyers drawn from hashes of their id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from homematch import lookups
from homematch.operators.ranking import hash_order


def uniform(key: Column, draw: str, seed: int) -> Column:
    """Number in (0, 1) that depends on the id, the draw and the seed only."""
    text = hash_order(F.concat_ws(":", F.lit(draw), key.cast("string")), seed)
    return (F.conv(F.substring(text, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 32))


def normal(key: Column, draw: str, seed: int, mean: float, deviation: float) -> Column:
    """Normal number by the Box-Muller transform."""
    radius = F.sqrt(-2 * F.ln(uniform(key, draw + "-radius", seed)))
    angle = F.cos(2 * F.pi() * uniform(key, draw + "-angle", seed))
    return F.lit(mean) + F.lit(deviation) * radius * angle


def choice(key: Column, draw: str, seed: int, options: list[str]) -> Column:
    """One of the options, all equally likely."""
    place = F.floor(uniform(key, draw, seed) * len(options)).cast("int")
    return F.get(F.array(*[F.lit(o) for o in options]), place)


def whole(key: Column, draw: str, seed: int, low: int, high: int) -> Column:
    """Whole number from ``low`` up to, not including, ``high``."""
    return (F.floor(uniform(key, draw, seed) * (high - low)) + low).cast("int")


def synthetic_buyers(ids: DataFrame, seed: int = 42) -> DataFrame:
    """One buyer per row of a frame with a column ``id``, such as ``spark.range(n)``."""
    key = F.col("id")
    return ids.select(
        "id",
        normal(key, "income", seed, 70000.0, 15000.0).alias("income"),
        normal(key, "savings", seed, 30000.0, 10000.0).alias("savings"),
        choice(key, "location", seed, lookups.BUYER_LOCATIONS).alias("preferred_location"),
        choice(key, "type", seed, lookups.BUYER_TYPES).alias("desired_property_type"),
        choice(key, "must", seed, lookups.BUYER_MUST_HAVES).alias("must_have_features"),
        choice(key, "nice", seed, lookups.BUYER_NICE_TO_HAVES).alias("nice_to_have_features"),
        whole(key, "commute", seed, 10, 60).alias("max_commute_time"),
        whole(key, "family", seed, 1, 6).alias("family_size"),
        choice(key, "tenure", seed, lookups.BUYER_TENURES).alias("tenure_preference"),
    )
