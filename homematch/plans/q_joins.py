"""Queries of the joins, the merge and the unions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from homematch.functions import numbers, text
from homematch.operators import encode, joins
from homematch.operators.joins import merged_key, one_row
from homematch.operators.ranking import first_by_key
from homematch.operators.unions import distinct_union, stacked
from homematch.plans import sqltext as S
from homematch.plans.catalog import day, query, rounded, whole
from homematch.plans.views import AS_OF
from homematch.session import saved


@query("c1_first_listing_join", """
    SELECT h.id, l.id AS listing_id, l.price AS listing_price FROM registry h LEFT JOIN first_listing l ON h.postal_code = l.address""", "registry first_listing")
def c1(t):
    matched = joins.match_listings(t.registry, saved(t.listing, "listings"))
    return matched.select("id", F.col("lp.id").alias("listing_id"), F.col("lp.price").alias("listing_price"))


@query("c2_unmatched_listings", """
    SELECT l.id, l.address FROM listing l WHERE l.id NOT IN (SELECT f.id FROM first_listing f JOIN registry h ON h.postal_code = f.address)""", "listing first_listing registry")
def c2(t):
    listings = saved(t.listing, "listings")
    return joins.unmatched_listings(listings, joins.match_listings(t.registry, listings)).select("id", "address")


_MERGED = ["postal_code", "property_type", "property_age", "tenure", "bedrooms", "bathrooms", "epc_rating", "size",
           "data_source", "listing_time", "county"]


@query("c3_merged_table", f"""
    SELECT historical_id, listing_id, round(price, 4) AS price, strftime("date", '%Y-%m-%d') AS "date", {', '.join(_MERGED)},
           array_to_string(features, '|') AS features, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM merged""", "merged")
def c3(t):
    return t.merge().select(
        "historical_id", "listing_id", rounded("price", 4).alias("price"), day("date").alias("date"), *_MERGED,
        F.array_join("features", "|").alias("features"), rounded("latitude").alias("latitude"), rounded("longitude").alias("longitude"),
    )


@query("c3_merged_ids", """
    SELECT row_number() OVER (ORDER BY md5('0:' || coalesce(historical_id, 'L' || listing_id)), coalesce(historical_id, 'L' || listing_id)) AS id,
           historical_id, listing_id FROM merged""", "merged")
def c3_ids(t):
    return joins.with_merged_ids(t.merged).select("id", "historical_id", "listing_id")


def _numbered(t) -> DataFrame:
    """Merged rows with ids taken from their keys: registry rows even, listing rows odd."""
    number = F.coalesce(F.substring("historical_id", 2, 20).cast("bigint") * 2, F.col("listing_id") * 2 + 1)
    return t.merged.select(number.alias("id"), "listing_id", "price")


@query("c4_processed_with_url", """
    WITH m AS (SELECT coalesce(CAST(substr(historical_id, 2) AS BIGINT) * 2, listing_id * 2 + 1) AS id, listing_id, price FROM merged)
    SELECT m.id AS original_id, m.listing_id, l.property_url, round(m.price, 4) AS price FROM m LEFT JOIN listing l ON l.id = m.listing_id""", "merged listing")
def c4(t):
    merged = _numbered(t)
    processed = merged.select(F.col("id").alias("original_id"), "price")
    linked = joins.with_listing_url(processed, merged, t.listing)
    return linked.select("original_id", "listing_id", "property_url", rounded("price", 4).alias("price"))


@query("c5_tenure_pools", """
    SELECT CAST(pool AS INTEGER) AS pool, count(*) AS n, CAST(sum(property_id) AS BIGINT) AS checksum FROM ranked_pool GROUP BY 1""", "ranked_pool")
def c5(t):
    from homematch.operators.pairs import tenure_pools

    return tenure_pools(t.props).groupBy("pool").agg(F.count(F.lit(1)).alias("n"), F.sum("property_id").alias("checksum"))


_DISTANCE = S.centre_distance("latitude", "longitude", "county")


@query("c6_location_flags", f"""
    SELECT id, {', '.join(f"CASE WHEN {S.location_class(_DISTANCE)} = '{n}' THEN 1 ELSE 0 END AS location_{n}" for n in ('Urban', 'Suburban', 'Rural'))}
    FROM listing""", "listing")
def c6(t):
    flags = encode.location_flags(F.col("latitude"), F.col("longitude"), F.col("county"))
    return t.listing.select("id", *[c.alias(n) for n, c in flags.items()])


@query("c7_dictionary_lookups", f"""
    SELECT id, {S.property_class('property_type')} AS class, {S.shire('county')} AS shire,
           {S.case_of(S.epc('epc_rating'), dict(G=1, F=2, E=3, D=4, C=5, B=6, A=7), '0')} AS epc, CAST({S.tenure_code('tenure')} AS INTEGER) AS tenure
    FROM listing""", "listing")
def c7(t):
    return t.listing.select(
        "id", text.property_class(F.col("property_type")).alias("class"), text.shire(F.col("county")).alias("shire"),
        text.epc_code(text.epc_letter(F.col("epc_rating"))).alias("epc"), text.tenure_code(F.col("tenure")).alias("tenure"),
    )


@query("c8_average_buyer", """
    WITH m AS (SELECT avg(income) AS avg_income, avg(savings) AS avg_savings FROM users)
    SELECT id, round(price / avg_income, 6) AS price_to_income_ratio, round(price / avg_savings, 6) AS price_to_savings_ratio,
           round((avg_income * 4 + avg_savings) / price, 6) AS affordability_score FROM listing, m""", "listing users")
def c8(t):
    built = encode.affordability(t.listing, t.users)
    return built.select("id", *[rounded(c).alias(c) for c in ("price_to_income_ratio", "price_to_savings_ratio", "affordability_score")])


def gazetteers(t) -> tuple[DataFrame, DataFrame]:
    return t.gazetteer_a.where("known").drop("known"), t.gazetteer_b.where("known").drop("known")


@query("c9_coordinates_of_addresses", """
    WITH k AS (SELECT DISTINCT address || ', UK' AS address_key FROM listing)
    SELECT k.address_key, round(CASE WHEN a.address_key IS NOT NULL THEN a.latitude ELSE b.latitude END, 6) AS latitude,
           round(CASE WHEN a.address_key IS NOT NULL THEN a.longitude ELSE b.longitude END, 6) AS longitude
    FROM k LEFT JOIN (SELECT * FROM gazetteer_a WHERE known) a ON a.address_key = k.address_key
           LEFT JOIN (SELECT * FROM gazetteer_b WHERE known) b ON b.address_key = k.address_key""", "listing gazetteer_a gazetteer_b")
def c9(t):
    found = joins.coordinates_for(t.listing, "address", *gazetteers(t))
    return found.select("address_key", rounded("latitude").alias("latitude"), rounded("longitude").alias("longitude"))


_BACKFILL = """
    place AS (SELECT coalesce(a.address_key, b.address_key) AS address_key,
                     CASE WHEN a.address_key IS NOT NULL THEN a.latitude ELSE b.latitude END AS lat,
                     CASE WHEN a.address_key IS NOT NULL THEN a.longitude ELSE b.longitude END AS lon
              FROM (SELECT * FROM gazetteer_a WHERE known) a FULL JOIN (SELECT * FROM gazetteer_b WHERE known) b ON a.address_key = b.address_key),
    lfill AS (SELECT l.id, l.latitude IS NULL OR l.longitude IS NULL AS lacking,
                     CASE WHEN (l.latitude IS NULL OR l.longitude IS NULL) AND p.lat IS NOT NULL THEN p.lat ELSE l.latitude END AS latitude,
                     CASE WHEN (l.latitude IS NULL OR l.longitude IS NULL) AND p.lat IS NOT NULL THEN p.lon ELSE l.longitude END AS longitude
              FROM listing l LEFT JOIN place p ON p.address_key = l.address || ', UK'),
    upd AS (SELECT id, latitude, longitude FROM lfill WHERE lacking AND latitude IS NOT NULL AND longitude IS NOT NULL),
    mcopy AS (SELECT m.historical_id, m.listing_id, m.postal_code, CASE WHEN u.id IS NOT NULL THEN u.latitude ELSE m.latitude END AS latitude,
                     CASE WHEN u.id IS NOT NULL THEN u.longitude ELSE m.longitude END AS longitude
              FROM merged m LEFT JOIN upd u ON u.id = m.listing_id),
    mfill AS (SELECT c.historical_id, c.listing_id,
                     CASE WHEN (c.latitude IS NULL OR c.longitude IS NULL) AND p.lat IS NOT NULL THEN p.lat ELSE c.latitude END AS latitude,
                     CASE WHEN (c.latitude IS NULL OR c.longitude IS NULL) AND p.lat IS NOT NULL THEN p.lon ELSE c.longitude END AS longitude
              FROM mcopy c LEFT JOIN place p ON p.address_key = c.postal_code || ', UK')"""


@query("c10_backfill_coordinates", f"""
    WITH {_BACKFILL} SELECT historical_id, listing_id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM mfill""",
       "listing merged gazetteer_a gazetteer_b")
def c10(t):
    _, merged = joins.backfill_coordinates(t.listing, t.merged, *gazetteers(t))
    return merged.select("historical_id", "listing_id", rounded("latitude").alias("latitude"), rounded("longitude").alias("longitude"))


@query("c10_backfilled_listings", f"""
    WITH {_BACKFILL} SELECT id, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude FROM lfill""", "listing merged gazetteer_a gazetteer_b")
def c10_listings(t):
    listings, _ = joins.backfill_coordinates(t.listing, t.merged, *gazetteers(t))
    return listings.select("id", rounded("latitude").alias("latitude"), rounded("longitude").alias("longitude"))


@query("c11_score_one_buyer", """
    WITH u AS (SELECT avg(income) AS income, avg(savings) AS savings, avg(profile_score) AS s FROM profiles)
    SELECT id, round(1 / (1 + exp(-(property_score + s))), 6) AS probability, price <= income * 4 + savings AS affordable FROM props, u""", "props profiles")
def c11(t):
    buyer = one_row(t.profiles.agg(F.avg("income").alias("income"), F.avg("savings").alias("savings"), F.avg("profile_score").alias("score")))
    score = F.col("property_score") + buyer["score"]
    return t.props.select(
        "id", rounded(1 / (1 + F.exp(-score))).alias("probability"),
        (F.col("price") <= buyer["income"] * 4 + buyer["savings"]).alias("affordable"),
    )


@query("e6_first_row_per_key", "SELECT address, id, title FROM first_listing", "first_listing")
def e6(t):
    return first_by_key(t.listing, "address", "id").select("address", "id", "title")


@query("g1_union_of_sources", """
    SELECT id AS text_id, NULL AS number_id, CAST(price AS DOUBLE) AS price, postal_code AS place, 'registry' AS source FROM registry
    UNION ALL SELECT NULL, id, price, address, 'scraped' FROM listing""", "registry listing")
def g1(t):
    history = t.registry.select(F.col("id").alias("text_id"), F.col("price").cast("double").alias("price"), F.col("postal_code").alias("place"), F.lit("registry").alias("source"))
    listed = t.listing.select(F.col("id").alias("number_id"), "price", F.col("address").alias("place"), F.lit("scraped").alias("source"))
    return stacked(history, listed)


@query("g2_union_of_branches", "SELECT data_source, count(*) AS n, CAST(sum(CAST(round(price) AS BIGINT)) AS BIGINT) AS total FROM merged GROUP BY 1", "merged")
def g2(t):
    return t.merge().groupBy("data_source").agg(F.count(F.lit(1)).alias("n"), F.sum(F.round("price").cast("bigint")).alias("total"))


@query("g3_distinct_urls", """
    SELECT property_url FROM listing UNION SELECT 'https://homes.example/details/' || l_partkey FROM lineitem
    UNION SELECT url FROM pages""", "listing")
def g3(t):
    sold = t.lineitem.select(F.concat(F.lit("https://homes.example/details/"), F.col("l_partkey").cast("string")).alias("property_url"))
    return distinct_union("property_url", t.listing, sold, t.pages.withColumnRenamed("url", "property_url"))
