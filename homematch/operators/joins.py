"""Joins between registry, listings, merged rows, coordinates and statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from homematch.functions import dates, text
from homematch.operators.ranking import first_by_key, hash_rank
from homematch.session import saved


def one_row(df: DataFrame) -> Column:
    """The single row of a frame as a struct value, for use in one expression."""
    return df.select(F.struct(*[F.col(c) for c in df.columns])).scalar()


def with_row(df: DataFrame, row: DataFrame, name: str) -> DataFrame:
    """Frame with the single row of another one as struct column ``name``.

    The row is a scalar subquery that is planned once however many of its
    fields are used.
    """
    return df.withColumn(name, one_row(row))


def join_statistics(df: DataFrame, statistics: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach per-group figures to every row of the group; null keys match null keys.

    A plain join at every size: adaptive execution broadcasts figures that turn
    out small in bytes and otherwise splits the rows of a hot group.
    """
    named = statistics.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return df.join(named, same, "left").drop(*[f"_{k}" for k in keys])


def left_join_present(df: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join in which rows without a key are spread out.

    They get a hash of their other columns beside the null key, instead of all
    meeting in one task. The salt of present keys is 0, on the right worked out
    from the key: a literal there would be put into the condition and leave the
    rows dealt by key alone. It is a merge join: the right side is judged by
    files far smaller than its rows and would be broadcast, or the left one,
    once shuffled, be read again in as few tasks as wrote it.
    """
    spread = F.when(F.col(key).isNull(), F.xxhash64(*[c for c in df.columns if c != key])).otherwise(F.lit(0).cast("bigint"))
    left = df.withColumns({"_key": F.col(key), "_salt": spread})
    salted = right.withColumn("_salt", F.pmod(F.xxhash64(key), F.lit(1))).withColumnRenamed(key, "_key")
    return left.join(salted.hint("merge"), ["_key", "_salt"], "left").drop("_key", "_salt")


def first_listing_per_address(listings: DataFrame) -> DataFrame:
    """Listing with the lowest id at each address."""
    return first_by_key(listings.where(F.col("address").isNotNull()), "address", "id")


def match_listings(historical: DataFrame, listings: DataFrame, key: str = "postal_code") -> DataFrame:
    """Every historical row with its first listing as struct ``lp``, or null."""
    first = first_listing_per_address(listings)
    packed = first.select(F.col("address").alias(key), F.struct(*first.columns).alias("lp"))
    return left_join_present(historical, packed, key)


def unmatched_listings(listings: DataFrame, matched: DataFrame) -> DataFrame:
    """Listings that no historical row of ``matched`` took."""
    taken = matched.where(F.col("lp").isNotNull()).select(F.col("lp.id").alias("id")).distinct()
    return listings.join(taken, "id", "left_anti")


def merged_rows(historical: DataFrame, listings: DataFrame, as_of: dt.date) -> DataFrame:
    """Registry and listings as one table, without ids.

    Matched and unmatched registry rows come first, then the listings left over.
    A registry price of 0 counts as missing. The registry is read and shuffled
    once; which listings it took is read off the match, which is written once.
    """
    lp = F.col("lp")
    found = lp.isNotNull()
    pairs = saved(match_listings(historical, listings), "matched")
    matched = pairs.select(
        F.col("id").alias("historical_id"),
        lp["id"].alias("listing_id"),
        F.coalesce(F.nullif(F.col("price").cast("double"), F.lit(0.0)), lp["price"]).alias("price"),
        "postal_code",
        text.property_class(F.coalesce(F.col("property_type"), lp["property_type"])).alias("property_type"),
        F.col("date_of_transaction").alias("date"),
        "property_age",
        text.resolved_tenure(F.col("duration"), lp["tenure"]).alias("tenure"),
        text.first_number(lp["bedrooms"]).alias("bedrooms"),
        text.first_number(lp["bathrooms"]).alias("bathrooms"),
        text.epc_letter(lp["epc_rating"]).alias("epc_rating"),
        text.size_text(lp["size"]).alias("size"),
        lp["features"].alias("features"),
        F.when(found, "both").otherwise("historical").alias("data_source"),
        lp["listing_time"].alias("listing_time"),
        lp["latitude"].alias("latitude"),
        lp["longitude"].alias("longitude"),
        text.shire(F.when(found, lp["county"]).otherwise(F.col("district"))).alias("county"),
    )
    rest = unmatched_listings(listings, pairs).select(
        F.col("id").alias("listing_id"),
        F.col("price").cast("double").alias("price"),
        F.col("address").alias("postal_code"),
        text.property_class(F.col("property_type")).alias("property_type"),
        dates.listing_date(F.col("listing_time"), as_of).alias("date"),
        F.coalesce("tenure", F.lit("Unknown")).alias("tenure"),
        text.first_number(F.col("bedrooms")).alias("bedrooms"),
        text.first_number(F.col("bathrooms")).alias("bathrooms"),
        text.epc_letter(F.col("epc_rating")).alias("epc_rating"),
        text.size_text(F.col("size")).alias("size"),
        "features",
        F.lit("listing").alias("data_source"),
        "listing_time",
        "latitude",
        "longitude",
        text.shire(F.col("county")).alias("county"),
    )
    return matched.unionByName(rest, allowMissingColumns=True)


def merged_key() -> Column:
    """Text that names a merged row: its registry id, else its listing id."""
    return F.coalesce(F.col("historical_id"), F.concat(F.lit("L"), F.col("listing_id").cast("string")))


def with_merged_ids(merged: DataFrame) -> DataFrame:
    """Number merged rows from 1 in the hash order of their key; they are written once beforehand."""
    keyed = saved(merged.withColumn("_key", merged_key()), "merged")
    ranked = hash_rank(keyed, "_key", rank="_rank", total="_rows")
    return ranked.select((F.col("_rank") + 1).alias("id"), *merged.columns)


def with_listing_url(processed: DataFrame, merged: DataFrame, listings: DataFrame, key: str = "original_id") -> DataFrame:
    """Processed rows with the listing id of their merged row and its address on the web."""
    links = merged.select(F.col("id").alias(key), "listing_id")
    urls = listings.select(F.col("id").alias("listing_id"), "property_url")
    return processed.join(left_join_present(links, urls, "listing_id"), key)


def average_buyer(users: DataFrame) -> DataFrame:
    """Mean income and savings, one row."""
    return users.agg(F.avg("income").alias("avg_income"), F.avg("savings").alias("avg_savings"))


def coordinates_for(addresses: DataFrame, address: str, primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Coordinates of each distinct cleaned address, from the first gazetteer that knows it.

    Addresses that neither has whole coordinates for stay, with nulls.
    """
    keys = addresses.select(text.address_key(F.col(address)).alias("address_key")).where(F.col("address_key").isNotNull()).distinct()
    found = keys.join(known_places(primary, secondary), "address_key", "left")
    return found.select("address_key", F.col("_found.latitude").alias("latitude"), F.col("_found.longitude").alias("longitude"))


def known_places(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Whole coordinates of both gazetteers, one place per ``address_key`` as ``_found``.

    The first gazetteer takes precedence wherever it has both coordinates; of
    several rows of one key the one with the smallest coordinates counts.
    """
    place = F.struct("latitude", "longitude")
    ranked = primary.select("address_key", F.lit(0).alias("_rank"), place.alias("_found")).unionByName(
        secondary.select("address_key", F.lit(1).alias("_rank"), place.alias("_found")))
    whole = F.col("_found.latitude").isNotNull() & F.col("_found.longitude").isNotNull()
    best = ranked.where(whole).groupBy("address_key").agg(F.min(F.struct("_rank", "_found")).alias("_best"))
    return best.select("address_key", F.col("_best._found").alias("_found"))


def fill_coordinates(df: DataFrame, address: str, primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Fill the coordinates of rows that lack one; rows not found keep what they had.

    A half-filled pair is replaced as a whole when its address is known. The
    rows are read and shuffled once.
    """
    lacking = F.col("latitude").isNull() | F.col("longitude").isNull()
    keyed = df.withColumn("address_key", F.when(lacking, text.address_key(F.col(address))))
    return _use_found(left_join_present(keyed, known_places(primary, secondary), "address_key"), df.columns)


def _use_found(joined: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Take the coordinates in ``_found`` where there are any."""
    use = F.col("_found").isNotNull()
    return joined.withColumns({
        "latitude": F.when(use, F.col("_found.latitude")).otherwise(F.col("latitude")),
        "longitude": F.when(use, F.col("_found.longitude")).otherwise(F.col("longitude")),
    }).select(*columns)


def backfill_coordinates(
    listings: DataFrame, merged: DataFrame, primary: DataFrame, secondary: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """Fill listings, copy what was found to their merged rows, then fill the rest by postal code."""
    filled = fill_coordinates(listings, "address", primary, secondary)
    before = listings.where(F.col("latitude").isNull() | F.col("longitude").isNull()).select("id")
    updated = filled.where(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).join(before, "id", "left_semi")
    updates = updated.select(F.col("id").alias("listing_id"), F.struct("latitude", "longitude").alias("_found"))
    copied = _use_found(left_join_present(merged, updates, "listing_id"), merged.columns)
    return filled, fill_coordinates(copied, "postal_code", primary, secondary)
