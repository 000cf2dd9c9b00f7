"""Queries of the text, date, number and list functions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from homematch import lookups
from homematch.functions import arrays, dates, numbers, text
from homematch.operators.joins import average_buyer, one_row
from homematch.plans import sqltext as S
from homematch.plans.catalog import day, query, rounded, whole
from homematch.plans.jobs import with_source_date
from homematch.plans.views import AS_OF

TODAY = dt.date.fromisoformat(AS_OF)


@query("h1_standardise_price", f"SELECT id, price AS raw, {S.price('price')} AS price FROM listing_raw", "listing_raw")
def h1(t):
    return t.listing_raw.select("id", F.col("price").alias("raw"), text.price_number(F.col("price")).alias("price"))


@query("h2_standardise_epc", f"SELECT id, {S.epc('epc_rating')} AS epc FROM listing_raw", "listing_raw")
def h2(t):
    return t.listing_raw.select("id", text.epc_letter(F.col("epc_rating")).alias("epc"))


@query("h3_extract_number", f"SELECT id, {S.number('bedrooms')} AS bedrooms, {S.number('bathrooms')} AS bathrooms FROM listing_raw", "listing_raw")
def h3(t):
    return t.listing_raw.select("id", text.first_number(F.col("bedrooms")).alias("bedrooms"), text.first_number(F.col("bathrooms")).alias("bathrooms"))


@query("h3_first_number_in_texts", f"SELECT conv_id, turn, {S.number('text')} AS first_number FROM conversations")
def h3_texts(t):
    return t.conversations.select("conv_id", "turn", text.first_number(F.col("text")).alias("first_number"))


@query("h4_standardise_size", f"SELECT id, {S.size('size')} AS size FROM listing_raw", "listing_raw")
def h4(t):
    return t.listing_raw.select("id", text.size_text(F.col("size")).alias("size"))


@query("h5_extract_sq_ft", f"SELECT id, {S.square_feet('size')} AS size_sq_ft FROM listing_raw", "listing_raw")
def h5(t):
    return t.listing_raw.select("id", text.square_feet(F.col("size")).alias("size_sq_ft"))


_ADDRESS = "paon || ' @' || street || ',,' || town_city || '!!  '"
#: The same with the number of every second town alone and twice, which cleaning takes off again.
_REPEATED = "paon || ' @' || street || ',,' || CASE WHEN substr(id, -1) IN ('1', '3', '5', '7', '9') THEN split_part(town_city, ' ', 2) || '  ' || split_part(town_city, ' ', 2) ELSE town_city END || '!!  '"


@query("h6_clean_address", rf"""
    WITH r AS (SELECT id, paon, street, CASE WHEN substr(id, -1) IN ('1', '3', '5', '7', '9') THEN split_part(town_city, ' ', 2) ELSE town_city END AS town_city FROM registry),
    a AS (SELECT id, trim(regexp_replace(regexp_replace({_ADDRESS}, '[^\w\s,]', '', 'g'), '\s+', ' ', 'g')) AS x FROM r),
    b AS (SELECT id, regexp_replace(regexp_replace(x, ',+', ',', 'g'), ',(\S)', ', \1', 'g') AS x FROM a)
    SELECT id, CASE WHEN lower(x) LIKE '%uk' OR lower(x) LIKE '%united kingdom' THEN x ELSE x || ', UK' END AS address FROM b""", "registry")
def h6(t):
    return t.registry.select("id", text.address_key(F.expr(_REPEATED)).alias("address"))


@query("h6_clean_documents")
def h6_documents(t):
    cleaned = t.documents.select("doc_id", text.address_key(F.col("text")).alias("cleaned"))
    return cleaned.select("doc_id", F.length("cleaned").alias("cleaned_chars"), F.md5("cleaned").alias("cleaned_hash"))


@query("h7_address_with_county", """
    SELECT id, trim(CASE WHEN contains(street || ', ' || county, 'BUCKINGHAMSHIRE') THEN street || ', ' || county
                    ELSE street || ', ' || county || ', BUCKINGHAMSHIRE' END) AS address FROM registry""", "registry")
def h7(t):
    return t.registry.select("id", text.with_shire(F.concat_ws(", ", "street", "county"), "BUCKINGHAMSHIRE").alias("address"))


_PARTS = ["street", "locality", "town_city", "district", "county"]


@query("h8_registry_address", f"SELECT id, concat_ws(', ', {', '.join(f'nullif({p}, {chr(39) * 2})' for p in _PARTS)}) AS address FROM registry", "registry")
def h8(t):
    return t.registry.select("id", text.joined_address(*[F.col(p) for p in _PARTS]).alias("address"))


@query("h9_cleansed_county", "SELECT id, regexp_replace(upper(county), '^(NORTH|WEST) ', '') AS county FROM registry", "registry")
def h9(t):
    return t.registry.select("id", text.cleansed_county(F.col("county")).alias("county"))


@query("h10_shire_of_district", f"SELECT id, {S.shire('district')} AS shire FROM registry", "registry")
def h10(t):
    return t.registry.select("id", text.shire(F.col("district")).alias("shire"))


@query("h11_property_class", f"SELECT id, {S.property_class('property_type')} AS class FROM listing_raw", "listing_raw")
def h11(t):
    return t.listing_raw.select("id", text.property_class(F.col("property_type")).alias("class"))


@query("h12_registry_code", f"SELECT id, {S.case_of('property_type', lookups.LISTING_TO_REGISTRY)} AS code FROM listing_raw", "listing_raw")
def h12(t):
    return t.listing_raw.select("id", text.registry_code(F.col("property_type")).alias("code"))


@query("h13_tenure_of_features", f"SELECT id, {S.tenure('features')} AS tenure FROM listing_raw", "listing_raw")
def h13(t):
    return t.listing_raw.select("id", text.tenure_of(F.col("features")).alias("tenure"))


_STATUS = {"A": "Added", "D": "Deleted"}


@query("h14_code_label", f"SELECT id, {S.case_of('record_status', _STATUS, 'record_status')} AS status, property_type FROM registry", "registry")
def h14(t):
    return t.registry.select("id", text.code_label(F.col("record_status"), _STATUS).alias("status"), "property_type")


@query("h15_preference_code", f"SELECT id, CAST({S.preference('tenure_preference')} AS INTEGER) AS code FROM users", "users")
def h15(t):
    return t.users.select("id", text.preference_code(F.col("tenure_preference")).alias("code"))


@query("h16_resolved_tenure", """
    SELECT historical_id, data_source, tenure FROM merged WHERE data_source <> 'listing'""", "merged")
def h16(t):
    return t.merge().where("data_source <> 'listing'").select("historical_id", "data_source", "tenure")


@query("h17_tenure_code", f"SELECT id, CAST({S.tenure_code('tenure')} AS INTEGER) AS tenure FROM listing", "listing")
def h17(t):
    return t.listing.select("id", text.tenure_code(F.col("tenure")).alias("tenure"))


@query("h18_size_or_null", "SELECT id, nullif(size, 'Size info not available') AS size FROM listing_raw", "listing_raw")
def h18(t):
    return t.listing_raw.select("id", text.size_or_null(F.col("size")).alias("size"))


@query("h19_price_label", "SELECT id, '£' || format('{:,}', price) AS label FROM registry", "registry")
def h19(t):
    return t.registry.select("id", text.price_label(F.col("price")).alias("label"))


_LOCATIONS = {f"location_{n}": n for n in lookups.LOCATION_CLASSES}
_CLASSES = {lookups.type_column(n): n for n in lookups.PROPERTY_CLASSES}


@query("h20_flag_labels", f"""
    SELECT id, CASE {' '.join(f"WHEN {c} = 1 THEN '{n}'" for c, n in _LOCATIONS.items())} END AS location,
           CASE {' '.join(f"WHEN {c} = 1 THEN '{n}'" for c, n in _CLASSES.items())} END AS class,
           concat_ws(', ', CASE WHEN has_garden = 1 THEN 'Garden' END, CASE WHEN has_parking = 1 THEN 'Parking' END) AS amenities
    FROM props""", "props")
def h20(t):
    return t.props.select(
        "id", text.flag_label(_LOCATIONS).alias("location"), text.flag_label(_CLASSES).alias("class"),
        text.amenity_label(F.col("has_garden"), F.col("has_parking")).alias("amenities"),
    )


_LINK = "CASE WHEN p_size % 4 = 0 THEN '/agents/' ELSE '/details/' END || CAST(p_partkey AS STRING)"


@query("h21_absolute_url", f"""
    SELECT p_partkey, CASE WHEN starts_with({_LINK}, '/details/') THEN 'https://homes.example' || {_LINK} END AS url FROM part""")
def h21(t):
    return t.part.select("p_partkey", text.absolute_url("https://homes.example", F.expr(_LINK)).alias("url"))


_DATE_TEXT = "CASE o_orderkey % 5 WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10) WHEN 1 THEN '' WHEN 2 THEN 'not a date' WHEN 3 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || ' 00:00' ELSE substr(CAST(o_orderdate AS STRING), 1, 10) || ' 13:45:10' END"


@query("i1_parse_timestamp", f"""
    SELECT o_orderkey, strftime(TRY_CAST({_DATE_TEXT} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS parsed FROM orders""")
def i1(t):
    parsed = dates.parsed_timestamp(F.expr(_DATE_TEXT))
    return t.orders.select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd HH:mm:ss").alias("parsed"))


@query("i2_listing_date", f"SELECT id, listing_time, strftime({S.listing_day('listing_time')}, '%Y-%m-%d') AS listed FROM listing_raw", "listing_raw")
def i2(t):
    return t.listing_raw.select("id", "listing_time", day(dates.listing_date(F.col("listing_time"), TODAY)).alias("listed"))


@query("i3_calendar_parts", """
    SELECT event_id, year(ts) AS "year", month(ts) AS "month", isodow(ts) - 1 AS day_of_week FROM events""")
def i3(t):
    return t.events.select("event_id", *[whole(c).alias(n) for n, c in dates.calendar_parts(F.col("ts")).items()])


@query("i4_days_since", f"SELECT id, datediff('day', date_of_transaction, DATE '{AS_OF}') AS days FROM registry", "registry")
def i4(t):
    return t.registry.select("id", whole(dates.days_since(F.col("date_of_transaction"), TODAY)).alias("days"))


_DAYS = f"datediff('day', date_of_transaction, DATE '{AS_OF}')"


@query("i5_recency_class", f"SELECT id, {S.recency(_DAYS)} AS recency FROM registry", "registry")
def i5(t):
    return t.registry.select("id", dates.recency_class(dates.days_since(F.col("date_of_transaction"), TODAY)).alias("recency"))


_SOURCE = "CASE o_orderkey % 3 WHEN 0 THEN 'registry' WHEN 1 THEN 'scraped' ELSE 'other' END"


@query("i6_date_by_source", f"""
    SELECT o_orderkey, strftime(CASE {_SOURCE} WHEN 'registry' THEN CAST(TRY_CAST({_DATE_TEXT} AS TIMESTAMP) AS DATE)
           WHEN 'scraped' THEN DATE '2023-12-31' END, '%Y-%m-%d') AS "date" FROM orders""")
def i6(t):
    tagged = t.orders.selectExpr("o_orderkey", f"{_SOURCE} AS source", f"{_DATE_TEXT} AS recorded")
    return with_source_date(tagged, "recorded", dt.date(2023, 12, 31)).select("o_orderkey", day("Date").alias("date"))


@query("i7_in_year", "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) = 1997")
def i7(t):
    return t.orders.where(dates.in_year(F.col("o_orderdate"), 1997)).select("o_orderkey", "o_custkey")


@query("j1_price_ratios", """
    WITH m AS (SELECT avg(income) AS i, avg(savings) AS s FROM users)
    SELECT id, round(price / m.i, 6) AS price_to_income_ratio, round(price / m.s, 6) AS price_to_savings_ratio FROM registry, m""", "registry users")
def j1(t):
    buyer = one_row(average_buyer(t.users))
    built = numbers.average_ratios(F.col("price"), buyer["avg_income"], buyer["avg_savings"])
    return t.registry.select("id", *[rounded(built[c]).alias(c) for c in ("price_to_income_ratio", "price_to_savings_ratio")])


@query("j2_affordability_score", """
    WITH m AS (SELECT avg(income) AS i, avg(savings) AS s FROM users)
    SELECT id, round((m.i * 4 + m.s) / nullif(price, 0), 6) AS affordability_score FROM registry, m""", "registry users")
def j2(t):
    buyer = one_row(average_buyer(t.users))
    built = numbers.average_ratios(F.col("price"), buyer["avg_income"], buyer["avg_savings"])
    return t.registry.select("id", rounded(built["affordability_score"]).alias("affordability_score"))


@query("j3_pair_ratios", """
    SELECT p.user_id, p.property_id, round(h.price / (u.income + 1), 6) AS price_to_income_ratio,
           round(h.price / (u.savings + 1), 6) AS price_to_savings_ratio,
           round((u.income * 4 + u.savings) / (h.price + 1), 6) AS affordability_score
    FROM pairs p JOIN props h ON h.id = p.property_id JOIN users u ON u.id = p.user_id""", "pairs props users")
def j3(t):
    from homematch.operators.pairs import pair_rows, sample_pairs

    rows = pair_rows(sample_pairs(t.props, t.users), t.props.select("id", "price"), t.users.select("id", "income", "savings"))
    built = numbers.pair_ratios(F.col("price"), F.col("income"), F.col("savings"))
    return rows.select("user_id", "property_id", *[rounded(c).alias(n) for n, c in built.items()])


@query("j4_logarithms", "SELECT id, round(ln(1 + price), 6) AS log_price, round(ln(1 + size_sq_ft), 6) AS log_size FROM props", "props")
def j4(t):
    return t.props.select("id", rounded(F.log1p("price")).alias("log_price"), rounded(F.log1p("size_sq_ft")).alias("log_size"))


_DISTANCE = S.centre_distance("latitude", "longitude", "county")


@query("j5_location_class", f"""
    SELECT id, round({_DISTANCE}, 6) AS distance, {S.location_class(_DISTANCE)} AS location FROM listing_raw""", "listing_raw")
def j5(t):
    distance = numbers.centre_distance(F.col("latitude"), F.col("longitude"), F.col("county"))
    return t.listing_raw.select("id", rounded(distance).alias("distance"), numbers.location_class(distance).alias("location"))


@query("j6_price_segments", """
    WITH m AS (SELECT CAST(max(price) AS BIGINT) AS top FROM registry),
    n AS (SELECT unnest(range(CAST(floor((top - 1) / 20001) AS BIGINT) + 1)) AS segment, top FROM m)
    SELECT segment, segment * 20001 AS min_price, least(segment * 20001 + 20000, top) AS max_price FROM n""", "registry")
def j6(t):
    top = t.registry.agg(F.max("price").alias("top"))
    return top.select(F.inline(numbers.price_segments(F.col("top"), 20000)))


@query("j7_listings_per_segment", """
    SELECT county, CAST(floor(price / 20001) AS BIGINT) AS segment, count(*) AS n FROM listing GROUP BY 1, 2""", "listing")
def j7(t):
    return t.listing.groupBy("county", numbers.price_segment(F.col("price"), 20000).alias("segment")).agg(F.count(F.lit(1)).alias("n"))


@query("j8_confidence", """
    SELECT CASE WHEN probability > 0.5 THEN 1 ELSE 0 END = y AS correct, count(*) AS n, round(avg(abs(probability - 0.5)), 6) AS confidence
    FROM judged GROUP BY 1""", "judged")
def j8(t):
    scored = t.judged.withColumn("correct", (F.col("probability") > 0.5).cast("int") == F.col("y"))
    return scored.groupBy("correct").agg(F.count(F.lit(1)).alias("n"), rounded(F.avg(numbers.confidence(F.col("probability")))).alias("confidence"))


_NUMBER_TEXT = "CASE event_id % 4 WHEN 0 THEN props WHEN 1 THEN CAST(event_id AS STRING) WHEN 2 THEN '  -' || CAST(event_id % 100 AS STRING) || '.5 ' ELSE 'n/a' END"


@query("j9_number_or_null", f"SELECT event_id, TRY_CAST(trim({_NUMBER_TEXT}) AS DOUBLE) AS number FROM events")
def j9(t):
    return t.events.select("event_id", numbers.number_or_null(F.expr(_NUMBER_TEXT)).alias("number"))


@query("k1_has_garden", f"SELECT id, {S.mentions('features', 'garden')} AS has_garden FROM listing_raw", "listing_raw")
def k1(t):
    return t.listing_raw.select("id", arrays.mentions(F.col("features"), "garden").cast("int").alias("has_garden"))


@query("k2_has_parking", f"SELECT id, {S.mentions('features', 'parking')} AS has_parking FROM listing_raw", "listing_raw")
def k2(t):
    return t.listing_raw.select("id", arrays.mentions(F.col("features"), "parking").cast("int").alias("has_parking"))


@query("k3_list_or_empty", "SELECT id, CAST(coalesce(len(features), 0) AS INTEGER) AS items, coalesce(array_to_string(features, '|'), '') AS features FROM listing_raw", "listing_raw")
def k3(t):
    full = arrays.list_or_empty(F.col("features"))
    return t.listing_raw.select("id", F.size(full).alias("items"), F.array_join(full, "|").alias("features"))
