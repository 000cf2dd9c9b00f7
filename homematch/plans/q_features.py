"""Queries of the filling, coding and scaling steps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from homematch import schemas
from homematch.lookups import PROPERTY_CLASSES, SHIRES, type_column
from homematch.operators import encode, impute
from homematch.plans import sqltext as S
from homematch.plans.catalog import day, query, rounded, whole
from homematch.plans.q_profile import PAIR_FEATURES
from homematch.plans.views import AS_OF

TODAY = dt.date.fromisoformat(AS_OF)
NUMBERS = ["price", "bedrooms", "bathrooms", "latitude", "longitude"]
TEXTS = ["postal_code", "property_type", "property_age", "tenure", "epc_rating", "data_source", "listing_time", "county"]


def merged_with_id(t):
    """Merged table under ids taken from the row keys."""
    number = F.coalesce(F.substring("historical_id", 2, 20).cast("bigint") * 2, F.col("listing_id") * 2 + 1)
    return t.merged.withColumn("id", number)


@query("m1_fill_numeric", f"""
    SELECT {S.MERGED_ID} AS id, {', '.join(f"round(coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM merged)), 4) AS {c}" for c in NUMBERS)} FROM merged""", "merged")
def m1(t):
    return impute.fill_numeric(merged_with_id(t)).select("id", *[rounded(c, 4).alias(c) for c in NUMBERS])


@query("m2_fill_categorical", f"""
    SELECT {S.MERGED_ID} AS id, {', '.join(f"coalesce({c}, {S.mode_of(c, 'merged')}) AS {c}" for c in TEXTS)},
           nullif(size, 'Size info not available') AS size, coalesce(array_to_string(features, '|'), '') AS features FROM merged""", "merged")
def m2(t):
    filled = impute.fill_categorical(merged_with_id(t))
    return filled.select("id", *TEXTS, "size", F.array_join("features", "|").alias("features"))


@query("m3_fill_size", f"""
    WITH sized AS (SELECT {S.MERGED_ID} AS id, property_type, bedrooms, {S.square_feet('size')} AS v FROM merged),
    e1 AS (SELECT s.*, coalesce(s.v, g.m) AS v1 FROM sized s LEFT JOIN (SELECT property_type, bedrooms, median(v) AS m FROM sized GROUP BY 1, 2) g
           ON g.property_type = s.property_type AND g.bedrooms = s.bedrooms),
    e2 AS (SELECT s.*, coalesce(s.v1, g.m) AS v2 FROM e1 s LEFT JOIN (SELECT property_type, median(v1) AS m FROM e1 GROUP BY 1) g ON g.property_type = s.property_type)
    SELECT id, round(coalesce(v2, (SELECT median(v2) FROM e2)), 4) AS size_sq_ft FROM e2""", "merged")
def m3(t):
    return impute.fill_size(merged_with_id(t)).select("id", rounded("size_sq_ft", 4).alias("size_sq_ft"))


@query("m4_fill_named_columns", f"""
    SELECT {S.MERGED_ID} AS id, {', '.join(f"coalesce(CAST({c} AS DOUBLE), (SELECT median({c}) FROM merged)) AS {c}" for c in ('bedrooms', 'bathrooms'))} FROM merged""", "merged")
def m4(t):
    return impute.fill_medians(merged_with_id(t), ["bedrooms", "bathrooms", "garages"]).select("id", "bedrooms", "bathrooms")


_LATITUDE = "CASE WHEN p_partkey % 9 = 0 THEN 'unknown' ELSE CAST(50 + p_partkey % 4 AS STRING) || '.25' END"


@query("m5_fill_coordinates", f"""
    WITH c AS (SELECT p_partkey, TRY_CAST({_LATITUDE} AS DOUBLE) AS latitude, CAST(-(p_partkey % 3) AS DOUBLE) AS longitude FROM part)
    SELECT p_partkey, coalesce(latitude, (SELECT median(latitude) FROM c)) AS latitude, longitude FROM c""")
def m5(t):
    texts = t.part.selectExpr("p_partkey", f"{_LATITUDE} AS latitude", "CAST(-(p_partkey % 3) AS STRING) AS longitude")
    return impute.fill_coordinate_medians(texts)


@query("m6_handle_missing", f"""
    SELECT id, {', '.join(f'round({c}, 4) AS {c}' for c in [*NUMBERS, 'size_sq_ft'])}, {', '.join(TEXTS)}, strftime("date", '%Y-%m-%d') AS "date" FROM handled""", "handled")
def m6(t):
    filled = impute.handle_missing(merged_with_id(t))
    return filled.select("id", *[rounded(c, 4).alias(c) for c in [*NUMBERS, "size_sq_ft"]], *TEXTS, day("date").alias("date"))


@query("m7_fill_generic", f"""
    SELECT id, coalesce(size_sq_ft, (SELECT median(size_sq_ft) FROM props)) AS size_sq_ft,
           coalesce(CAST(bedrooms AS DOUBLE), (SELECT median(bedrooms) FROM props)) AS bedrooms, CAST(NULL AS DOUBLE) AS nothing,
           coalesce(CASE WHEN tenure = 2 THEN NULL ELSE 'T' || tenure END, (SELECT 'T' || tenure FROM props WHERE tenure <> 2 GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS label,
           'Unknown' AS blank FROM props""", "props")
def m7(t):
    frame = t.props.select(
        "id", "size_sq_ft", "bedrooms", F.lit(None).cast("double").alias("nothing"),
        F.when(F.col("tenure") != 2, F.concat(F.lit("T"), F.col("tenure").cast("string"))).alias("label"), F.lit(None).cast("string").alias("blank"),
    )
    return impute.fill_generic(frame).withColumn("id", whole("id"))


@query("m8_fill_features", """
    SELECT id, CAST(price AS DOUBLE) AS price, coalesce(size_sq_ft, (SELECT median(size_sq_ft) FROM props)) AS size_sq_ft,
           coalesce(CAST(bedrooms AS DOUBLE), (SELECT median(bedrooms) FROM props)) AS bedrooms,
           CASE WHEN id % 5 = 0 THEN 0 ELSE has_garden END AS has_garden, county_berkshire FROM props""", "props")
def m8(t):
    holed = t.props.withColumn("has_garden", F.when(F.col("id") % 5 != 0, F.col("has_garden")))
    filled = impute.fill_features(holed, ["price", "size_sq_ft", "bedrooms"], ["has_garden", "county_berkshire"])
    return filled.select("id", "price", "size_sq_ft", "bedrooms", "has_garden", "county_berkshire")


_CLASS = "CASE WHEN class = 'Flat' THEN 'Flat/Maisonette' WHEN class IN ('Detached', 'Semi-Detached', 'Terraced', 'Flat/Maisonette') THEN class ELSE 'Other' END"


@query("l1_type_flags", f"""
    WITH c AS (SELECT id, CASE WHEN property_type IN ('Flat', 'Castle') THEN property_type ELSE {S.property_class('property_type')} END AS class FROM listing_raw)
    SELECT id, {', '.join(f"CASE WHEN {_CLASS} = '{n}' THEN 1 ELSE 0 END AS {type_column(n)}" for n in PROPERTY_CLASSES)} FROM c""", "listing_raw")
def l1(t):
    from homematch.functions.text import property_class

    kind = F.col("property_type")
    label = F.when(kind.isin("Flat", "Castle"), kind).otherwise(property_class(kind))
    return t.listing_raw.select("id", label.alias("class")).select("id", *[c.alias(n) for n, c in encode.type_flags(F.col("class")).items()])


@query("l2_county_flags", f"SELECT id, {', '.join(f'''CASE WHEN county = '{n}' THEN 1 ELSE 0 END AS county_{n}''' for n in SHIRES)} FROM listing", "listing")
def l2(t):
    return t.listing.select("id", *[c.alias(n) for n, c in encode.county_flags(F.col("county")).items()])


_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query("l2_flags_of_found_names", f"SELECT c_custkey, {', '.join(f'''CASE WHEN c_mktsegment = '{n}' THEN 1 ELSE 0 END AS county_{n}''' for n in _SEGMENTS)} FROM customer")
def l2_found(t):
    names = encode.county_names(t.customer, "c_mktsegment")
    return t.customer.select("c_custkey", *[c.alias(n) for n, c in encode.county_flags(F.col("c_mktsegment"), names).items()])


@query("l3_location_columns", "SELECT id, 0 AS \"location_Urban\", 0 AS \"location_Suburban\", 0 AS \"location_Rural\", CAST(tenure AS VARCHAR) AS tenure FROM listing", "listing")
def l3(t):
    return encode.with_location_columns(t.listing.select("id", "tenure"))


@query("l4_epc_code", f"SELECT id, {S.case_of(S.epc('epc_rating'), dict(G=1, F=2, E=3, D=4, C=5, B=6, A=7), '0')} AS epc FROM listing_raw", "listing_raw")
def l4(t):
    from homematch.functions.text import epc_code, epc_letter

    return t.listing_raw.select("id", epc_code(epc_letter(F.col("epc_rating"))).alias("epc"))


@query("l5_county_default", "SELECT id, coalesce(district, 'Unknown') AS county FROM registry", "registry")
def l5(t):
    return encode.with_county(t.registry.select("id", "district")).select("id", "county")


@query("l6_scale_calendar", """
    WITH c AS (SELECT id, year(date_of_transaction) AS y, month(date_of_transaction) AS m, isodow(date_of_transaction) - 1 AS d FROM registry)
    SELECT id, round((y - avg(y) OVER ()) / stddev_pop(y) OVER (), 6) AS "year", round((m - avg(m) OVER ()) / stddev_pop(m) OVER (), 6) AS "month",
           round((d - avg(d) OVER ()) / stddev_pop(d) OVER (), 6) AS day_of_week, CAST(0 AS DOUBLE) AS constant FROM c""", "registry")
def l6(t):
    from homematch.functions.dates import calendar_parts

    parts = t.registry.select("id", *[c.alias(n) for n, c in calendar_parts(F.col("date_of_transaction")).items()], F.lit(7).alias("constant"))
    columns = [*encode.CALENDAR, "constant"]
    return encode.scale(parts, encode.fit_scaler(parts, columns), columns).select("id", *[rounded(c).alias(c) for c in columns])


@query("l7_scale_by_training_rows", """
    WITH r AS (SELECT id, y, price, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || id), id) - 1 AS rnk, count(*) OVER (PARTITION BY y) AS n
               FROM (SELECT o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, o_totalprice AS price FROM orders)),
    s AS (SELECT *, CASE WHEN rnk < round(n * 0.2) THEN 1 ELSE 0 END AS is_test FROM r),
    f AS (SELECT avg(price) AS m, stddev_pop(price) AS d FROM s WHERE is_test = 0)
    SELECT id, is_test, round((price - m) / d, 5) AS z FROM s, f""")
def l7(t):
    from homematch.operators.pairs import stratified_split

    rows = t.orders.select(F.col("o_orderkey").alias("id"), (F.col("o_orderstatus") == "F").cast("int").alias("y"), F.col("o_totalprice").alias("price"))
    split = stratified_split(rows, "y", "id")
    scaler = encode.fit_scaler(split.where("is_test = 0"), ["price"])
    return encode.scale(split, scaler, ["price"]).select("id", "is_test", rounded("price", 5).alias("z"))


_ENGINEERED = ["year", "month", "day_of_week", "days_since_date", "epc_rating_encoded", "has_garden", "has_parking",
               *schemas.LOCATION_FLAGS, *schemas.COUNTY_FLAGS]


@query("l8_engineer_features", f"""
    SELECT id, {', '.join(f'"{c}"' for c in _ENGINEERED)}, listing_recency, round(price_relative_to_county_avg, 6) AS price_relative_to_county_avg FROM engineered""", "engineered")
def l8(t):
    from homematch.session import saved

    handled = saved(impute.handle_missing(merged_with_id(t)), "handled")
    built = encode.engineer(handled, TODAY)
    counted = ("year", "month", "day_of_week", "days_since_date")
    return built.select("id", *[(whole(c) if c in counted else F.col(c).cast("int")).alias(c) for c in _ENGINEERED], "listing_recency", rounded("price_relative_to_county_avg").alias("price_relative_to_county_avg"))


_OF_PAIR = {
    **{c: c for c in ("price", "size_sq_ft", "latitude", "bedrooms", "tenure", "log_price", "log_size", "income", "max_commute_time", "family_size")},
    "price_to_income_ratio": "pir", "price_to_savings_ratio": "psr", "affordability_score": "aff", "savings": "savings", "tenure_preference": "pref",
}
_VECTOR = ", ".join(f"CAST(r.{_OF_PAIR[c]} AS DOUBLE)" if c in _OF_PAIR else f"CAST(h.{c} AS DOUBLE)" for c in schemas.MODEL_FEATURES)


@query("l9_feature_vector", f"""
    WITH {PAIR_FEATURES}, vectors AS (SELECT r.user_id, r.property_id, [{_VECTOR}] AS features FROM ready r JOIN props h ON h.id = r.property_id)
    SELECT user_id, property_id, unnest(range(len(features))) AS place, round(unnest(features), 6) AS value FROM vectors""", "pairs props users")
def l9(t):
    from pyspark.ml.functions import vector_to_array

    from homematch.operators.model import assembled
    from homematch.operators.pairs import labelled_pairs

    vectors = assembled(labelled_pairs(t.props, t.users), schemas.MODEL_FEATURES)
    values = vectors.select("user_id", "property_id", F.posexplode(vector_to_array("features")).alias("place", "value"))
    return values.select("user_id", "property_id", whole("place").alias("place"), rounded("value").alias("value"))
