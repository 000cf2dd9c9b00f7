"""Queries of the sources, sinks and row filters."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from homematch import schemas
from homematch.functions import dates, text
from homematch.lookups import CLEANSE_TARGETS
from homematch.operators import encode, filters, profile
from homematch.operators.joins import merged_key
from homematch.operators.recommend import eligible_counts, shown
from homematch.plans import sqltext as S
from homematch.plans.catalog import day, query, rounded, whole
from homematch.plans.views import TABLES
from homematch.session import scratch_path
from homematch.sources import files, stores

REGISTRY_NAMES = {
    "id": "Unique Transaction Identifier", "price": "Price", "postal_code": "Postal Code", "property_type": "Property Type",
    "property_age": "Old/New", "duration": "Duration", "paon": "PAON", "saon": "SAON", "street": "Street",
    "locality": "Locality", "town_city": "Town/City", "district": "District", "county": "County",
    "ppd_category_type": "PPD Category Type", "record_status": "Record Status",
}


def registry_raw(t) -> DataFrame:
    """Registry view under the column names of the registry file."""
    named = t.registry.withColumn("Date of Transaction", F.date_format("date_of_transaction", "yyyy-MM-dd 00:00"))
    for old, new in REGISTRY_NAMES.items():
        named = named.withColumnRenamed(old, new)
    return named.select(*[F.col(f"`{c}`") for c in schemas.REGISTRY_COLUMNS])


def registry_file(t, header: bool = False) -> str:
    """Registry view written as a delimited file."""
    path = scratch_path(t.spark, "registry")
    registry_raw(t).write.option("header", header).option("escape", '"').csv(path)
    return path


_FILE_SQL = """
    SELECT id, price, strftime(date_of_transaction, '%Y-%m-%d') || ' 00:00' AS "date", nullif(postal_code, '') AS postal_code, nullif(property_type, '') AS property_type,
           nullif(property_age, '') AS property_age, nullif(duration, '') AS duration, nullif(paon, '') AS paon, nullif(saon, '') AS saon, nullif(street, '') AS street,
           nullif(locality, '') AS locality, nullif(town_city, '') AS town_city, nullif(district, '') AS district, nullif(county, '') AS county,
           nullif(ppd_category_type, '') AS ppd_category_type, nullif(record_status, '') AS record_status FROM registry"""


def _file_columns(df: DataFrame) -> DataFrame:
    named = {v: k for k, v in REGISTRY_NAMES.items()} | {"Date of Transaction": "date"}
    return df.select(*[F.col(f"`{c}`").cast("bigint" if c == "Price" else "string").alias(named[c]) for c in schemas.REGISTRY_COLUMNS])


@query("a1_headerless_csv", _FILE_SQL, "registry")
def a1(t):
    return _file_columns(files.read_registry(t.spark, registry_file(t)))


@query("a2_headered_csv", _FILE_SQL, "registry")
def a2(t):
    return _file_columns(files.read_csv(t.spark, registry_file(t, header=True), schemas.REGISTRY_RAW))


@query("a2_quoted_line_breaks", """
    SELECT doc_id, nullif(text, '') AS text, lang FROM documents""")
def a2_breaks(t):
    """Whole texts, with their line breaks and quotes, through delimited files."""
    from pyspark.sql import types as T

    path = scratch_path(t.spark, "texts")
    t.documents.select("doc_id", "text", "lang").write.option("header", True).option("escape", '"').option("quoteAll", True).csv(path)
    kinds = T.StructType.fromDDL("doc_id bigint, text string, lang string")
    return files.read_csv(t.spark, path, kinds)


_NULLS = "CASE o_orderkey % 4 WHEN 0 THEN 'null' WHEN 1 THEN 'NaN' WHEN 2 THEN '' ELSE o_orderpriority END"


@query("a3_csv_null_texts", "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN o_orderpriority END AS priority FROM orders")
def a3(t):
    path = scratch_path(t.spark, "null-texts")
    stores.write_csv(t.orders.selectExpr("CAST(o_orderkey AS STRING) AS o_orderkey", f"{_NULLS} AS priority"), path)
    read = files.read_csv_with_nulls(t.spark, path, ["o_orderkey", "priority"])
    return read.select(whole("o_orderkey").alias("o_orderkey"), "priority")


def listing_files(t) -> str:
    """Listing view written as JSON, one folder per shire."""
    path = scratch_path(t.spark, "listings")
    known = F.when(F.col("county") == F.lower("county"), F.col("county")).otherwise("berkshire")
    rows = t.listing_raw.withColumn("county", known).drop("latitude", "longitude")
    rows.write.partitionBy("county").json(path)
    return path


@query("a4_listing_files_by_county", """
    SELECT id, property_url, title, price, coalesce(array_to_string(features, '|'), '') AS features,
           CASE WHEN county = lower(county) THEN county ELSE 'berkshire' END AS county FROM listing_raw""", "listing_raw")
def a4(t):
    tagged = files.read_listings(t.spark, listing_files(t) + "/*", lines=True)
    return tagged.select("id", "property_url", "title", "price", F.coalesce(F.array_join("features", "|"), F.lit("")).alias("features"), "county")


@query("a5_read_by_extension", "SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(o_custkey) AS BIGINT) AS checksum, 'csv' AS kind FROM orders UNION ALL SELECT count(*), CAST(sum(o_custkey) AS BIGINT), 'json' FROM orders")
def a5(t):
    parts = []
    for kind in ("csv", "json"):
        path = f"{scratch_path(t.spark, 'any')}.{kind}"
        t.orders.select("o_orderkey", "o_custkey").write.option("header", True).format(kind).save(path)
        parts.append(files.read_any(t.spark, path, lines=True).agg(
            F.count(F.lit(1)).alias("n"), F.sum(whole("o_custkey")).alias("checksum")).withColumn("kind", F.lit(kind)))
    return parts[0].unionByName(parts[1])


@query("a6_whole_table_read", "SELECT * FROM customer")
def a6(t):
    return files.read_table(t.spark, f"{t.folder}/customer.parquet")


_JSON_LIST = (
    "CASE event_id % 4 WHEN 0 THEN '[\"' || event_type || '\",\"x\"]' "
    "WHEN 1 THEN '[' || chr(39) || event_type || chr(39) || ',' || chr(39) || 'y' || chr(39) || ']' WHEN 2 THEN '[broken' ELSE NULL END"
)


@query("a7_json_list", """
    SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_type || '|x' WHEN 1 THEN event_type || '|y' END AS listing_list,
           CASE event_id % 4 WHEN 0 THEN event_type || '|x' END AS merged_list FROM events""")
def a7(t):
    from homematch.functions.arrays import parsed_list

    raw = F.expr(_JSON_LIST)
    return t.events.select(
        "event_id", F.array_join(parsed_list(raw, single_quoted=True), "|").alias("listing_list"),
        F.array_join(parsed_list(raw), "|").alias("merged_list"),
    )


_DAY_TEXT = "CASE event_id % 4 WHEN 0 THEN substr(CAST(ts AS STRING), 1, 10) WHEN 1 THEN '' WHEN 2 THEN '2024-13-45' ELSE 'soon' END"


@query("a8_parse_date", "SELECT event_id, CASE WHEN event_id % 4 = 0 THEN substr(CAST(ts AS VARCHAR), 1, 10) END AS parsed FROM events")
def a8(t):
    return t.events.select("event_id", day(dates.parsed_date(F.expr(_DAY_TEXT))).alias("parsed"))


@query("a9_csv_sink", "SELECT id, price, bedrooms, coalesce('[' || '\"' || array_to_string(features, '\",\"') || '\"]', NULL) AS features FROM listing_raw", "listing_raw")
def a9(t):
    path = scratch_path(t.spark, "csv-sink")
    stores.write_csv(t.listing_raw.select("id", "price", "bedrooms", "features"), path)
    read = files.read_csv_with_nulls(t.spark, path, ["id", "price", "bedrooms", "features"])
    return read.withColumn("id", whole("id"))


@query("a10_json_generations", """
    SELECT 'current' AS generation, id, price, coalesce(county, 'none') AS county FROM listing
    UNION ALL SELECT 'previous', id, price * 2, coalesce(county, 'none') FROM listing""", "listing")
def a10(t):
    root = scratch_path(t.spark, "generations")
    base = t.listing.select("id", "price", F.coalesce("county", F.lit("none")).alias("county"))
    for factor in (3, 2, 1):
        stores.write_generation(base.withColumn("price", F.col("price") * factor), root, kind="json", partition_by=["county"])
    kinds = "id bigint, price double, county string"
    parts = [stores.read_generation(t.spark, root, back, "json", kinds).withColumn("generation", F.lit(name))
             for back, name in ((0, "current"), (1, "previous"))]
    return parts[0].unionByName(parts[1])


@query("a11_upsert_by_id", """
    SELECT coalesce(i.o_orderkey, o.o_orderkey) AS o_orderkey, coalesce(i.total, o.o_totalprice) AS total, i.o_orderkey IS NOT NULL AS updated
    FROM orders o FULL JOIN (
        SELECT o_orderkey, total FROM (
            SELECT l_orderkey AS o_orderkey, l_extendedprice AS total,
                   row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS rn
            FROM lineitem) WHERE rn = 1) i ON i.o_orderkey = o.o_orderkey""")
def a11(t):
    target = t.orders.select("o_orderkey", F.col("o_totalprice").alias("total"), F.lit(False).alias("updated"))
    place = {"unix_date(CAST(l_shipdate AS DATE))": 48, "l_linenumber": 45, "l_partkey": 20, "l_suppkey": 0}  # days, lines, parts and suppliers in one number
    order = F.expr(" + ".join(f"shiftleft(CAST({c} AS BIGINT), {bits})" for c, bits in place.items()))
    incoming = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_extendedprice").alias("total"), F.lit(True).alias("updated"), order.alias("loaded"))
    return stores.upsert(target, incoming, "o_orderkey", "loaded")


def _stored_and_incoming(t) -> tuple[DataFrame, DataFrame]:
    """Stored listings, and a later load of supplied parts that overlaps them and names some addresses twice."""
    stored = t.listing.where("property_type <> 'Studio' AND county IS NOT NULL")
    fresh = t.listing.where("county IS NULL OR county <> 'oxfordshire'").withColumns({
        "price": F.col("price") + 1000, "latitude": F.lit(None).cast("double"), "longitude": F.lit(None).cast("double"),
    })
    again = fresh.where("id % 5 = 0").withColumn("price", F.col("price") + 500)
    return stored, again.withColumn("loaded", F.lit(2)).unionByName(fresh.withColumn("loaded", F.lit(1)))


@query("a12_upsert_listings", """
    WITH stored AS (SELECT * FROM listing WHERE property_type <> 'Studio' AND county IS NOT NULL),
    fresh AS (SELECT * REPLACE (price + CASE WHEN id % 5 = 0 THEN 1500 ELSE 1000 END AS price) FROM listing WHERE county IS NULL OR county <> 'oxfordshire'),
    added AS (SELECT f.property_url, (SELECT max(id) FROM stored) + row_number() OVER (ORDER BY md5('0:' || f.property_url), f.property_url) AS id
              FROM fresh f ANTI JOIN stored s ON s.property_url = f.property_url)
    SELECT coalesce(s.id, a.id) AS id, coalesce(f.property_url, s.property_url) AS property_url, coalesce(f.price, s.price) AS price,
           s.latitude, s.longitude
    FROM fresh f FULL JOIN stored s ON s.property_url = f.property_url LEFT JOIN added a ON a.property_url = f.property_url""", "listing")
def a12(t):
    stored, fresh = _stored_and_incoming(t)
    return stores.upsert_listings(stored, fresh, "loaded").select("id", "property_url", "price", "latitude", "longitude")


@query("a13_load_geocoded", """
    SELECT CASE WHEN id % 7 = 3 THEN NULL ELSE id END AS id, price, strftime(DATE '2023-01-01' + CAST(id % 300 AS INTEGER), '%Y-%m-%d') AS "date",
           array_to_string(features, '|') AS features, CAST(latitude AS DOUBLE) AS latitude, 'loaded' AS state,
           CASE WHEN id % 14 = 3 THEN 'error: missing id' WHEN id % 7 = 3 THEN 'error: unreadable id' END AS reason FROM listing WHERE county IS NOT NULL
    UNION ALL SELECT id, price, NULL, array_to_string(features, '|'), latitude, 'kept', NULL FROM listing WHERE county IS NULL OR id % 7 = 3""", "listing")
def a13(t):
    """A file with some rows twice, the later one counting, and some without a readable id."""
    types = {"id": "bigint", "price": "double", "date": "date", "features": "array<string>", "latitude": "double", "state": "string"}
    columns = list(types)
    stored = t.listing.select("id", "price", F.lit(None).cast("date").alias("date"), "features", "latitude", F.lit("kept").alias("state"))
    dated = t.listing.where("county IS NOT NULL").select(
        F.expr("CASE WHEN id % 14 = 3 THEN NULL WHEN id % 7 = 3 THEN 'x' || id ELSE CAST(id AS STRING) END").alias("id"),
        "price", F.expr("date_add(DATE '2023-01-01', CAST(id % 300 AS INT))").alias("date"), "features", "latitude", F.lit("loaded").alias("state"))
    path = scratch_path(t.spark, "geocoded")
    stores.write_csv(dated.where("id IS NOT NULL AND NOT startswith(id, 'x')").withColumns({"price": F.lit(-1.0), "state": F.lit("replaced")}), f"{path}/1")
    stores.write_csv(dated, f"{path}/2")
    loaded = stores.geocoded_rows(files.read_csv_with_nulls(t.spark, [f"{path}/1", f"{path}/2"], columns, with_order=True), types)
    merged = stores.upsert(stored, stores.valid_rows(loaded), "id", files.ORDER).withColumn("reason", F.lit(None).cast("string"))
    shown = merged.unionByName(stores.quarantined_rows(loaded).drop(files.ORDER))
    return shown.select("id", "price", day("date").alias("date"), F.array_join("features", "|").alias("features"), "latitude", "state", "reason")


@query("a14_full_refresh", "SELECT o_orderkey, o_orderpriority FROM orders")
def a14(t):
    root = scratch_path(t.spark, "refresh")
    stores.refresh(t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("o_orderpriority")), root)
    stores.refresh(t.orders.select("o_orderkey", "o_orderpriority"), root)
    return stores.read_generation(t.spark, root)


@query("a15_load_summary", f"""
    SELECT 'listing' AS source, CASE WHEN {S.price('price')} IS NULL THEN 'skipped' ELSE 'processed' END AS status, count(*) AS n
    FROM listing_raw GROUP BY 2
    UNION ALL SELECT 'historical', CASE WHEN duration = 'U' THEN 'error' ELSE 'processed' END, count(*) FROM registry GROUP BY 2""", "listing_raw registry")
def a15(t):
    listing = stores.load_summary(stores.listing_rows(t.listing_raw)).select(F.lit("listing").alias("source"), "*")
    history = stores.load_summary(stores.historical_rows(registry_raw(t))).select(F.lit("historical").alias("source"), "*")
    return listing.unionByName(history)


@query("a15_quarantined_rows", "SELECT id, 'bad duration' AS reason FROM registry WHERE duration = 'U'", "registry")
def a15_rows(t):
    return stores.quarantined_rows(stores.historical_rows(registry_raw(t))).select("id", "reason")


@query("a16_stored_types", """
    SELECT id AS original_id, CAST(trunc(month / 5.0 - 1.3) AS INTEGER) AS "month", CAST(trunc(bedrooms * 1.5) AS INTEGER) AS bedrooms,
           has_garden = 1 AS has_garden, coalesce(tenure, 2) AS tenure, size_sq_ft FROM props""", "props")
def a16(t):
    shifted = t.props.withColumns({"month": F.col("month") / 5.0 - 1.3, "bedrooms": F.col("bedrooms") * 1.5})
    return encode.stored_types(shifted).select("original_id", "month", "bedrooms", "has_garden", "tenure", "size_sq_ft")


@query("a17_completeness", """
    SELECT 'listing' AS source, count(*) FILTER (latitude IS NULL OR longitude IS NULL) = 0 AS complete FROM listing
    UNION ALL SELECT 'gazetteer', count(*) FILTER (latitude IS NULL OR longitude IS NULL) = 0 FROM gazetteer_a""", "listing gazetteer_a")
def a17(t):
    found = [(n, stores.coordinates_complete(d)) for n, d in (("listing", t.listing), ("gazetteer", t.gazetteer_a))]
    return t.spark.createDataFrame(found, "source string, complete boolean")


@query("b1_shires_in_year", """
    SELECT id, regexp_replace(upper(county), '^(NORTH|WEST) ', '') AS county, price FROM registry
    WHERE regexp_replace(upper(county), '^(NORTH|WEST) ', '') IN ('BUCKINGHAMSHIRE', 'BEDFORD', 'OXFORDSHIRE', 'NORTHAMPTONSHIRE', 'HERTFORDSHIRE', 'BERKSHIRE')
      AND year(date_of_transaction) = 1998""", "registry")
def b1(t):
    return filters.shires_in_year(t.registry, "county", "date_of_transaction", CLEANSE_TARGETS, 1998).select("id", "county", "price")


@query("b2_priced_listings", f"SELECT id, {S.price('price')} AS price FROM listing_raw WHERE {S.price('price')} IS NOT NULL", "listing_raw")
def b2(t):
    return filters.with_price(t.listing_raw.select("id", text.price_number(F.col("price")).alias("price")))


@query("b3_without_coordinates", "SELECT id, address FROM listing WHERE latitude IS NULL OR longitude IS NULL", "listing")
def b3(t):
    return filters.without_coordinates(t.listing).select("id", "address")


@query("b4_eligible_properties", """
    SELECT a.id, count(e.property_id) AS eligible FROM asked a LEFT JOIN eligible e ON e.user_id = a.id GROUP BY a.id""", "asked eligible")
def b4(t):
    return eligible_counts(t.profiles, t.props)


@query("b4_mask_of_average_profile", """
    WITH m AS (SELECT avg(income) * 4 + avg(savings) AS budget FROM profiles)
    SELECT p.id, p.price FROM props p, m WHERE p.price <= m.budget AND p.county_oxfordshire = 1 AND p.location_Urban = 1 AND p.has_garden = 1""", "props profiles")
def b4_mask(t):
    from homematch.operators.joins import one_row

    buyer = one_row(t.profiles.agg(F.avg("income").alias("income"), F.avg("savings").alias("savings")))
    profile = {
        "income": buyer["income"], "savings": buyer["savings"], "preferred_county": "Oxfordshire", "preferred_location": "Urban",
        "desired_property_type": "Castle", "must_have_features": ["Garden", "Gym"],
    }
    return t.props.where(filters.profile_mask(t.props.columns, profile)).select("id", "price")


@query("b5_score_threshold", "SELECT id, probability FROM judged WHERE probability > 0.5", "judged")
def b5(t):
    return filters.above_threshold(t.judged, "probability").select("id", "probability")


_SHOWN = ["price", "size_sq_ft", *schemas.LOCATION_FLAGS, "has_garden", "has_parking", *schemas.TYPE_FLAGS]


@query("b6_fixed_projection", f"SELECT id, {', '.join(_SHOWN)} FROM props", "props")
def b6(t):
    return shown(t.props)


@query("b7_columns_by_prefix", f"SELECT id, {', '.join(schemas.COUNTY_FLAGS)} FROM props", "props")
def b7(t):
    return t.props.select("id", *filters.columns_with_prefix(t.props))


@query("b8_missing_columns", "SELECT id, price, 0 AS balcony, 0 AS log_size FROM props", "props")
def b8(t):
    return filters.with_missing_columns(t.props.select("id", "price"), ["price", "balcony", "log_size"])


@query("b9_complete_rows", "SELECT id, size_sq_ft, bedrooms FROM props WHERE size_sq_ft IS NOT NULL AND bedrooms IS NOT NULL AND latitude IS NOT NULL", "props")
def b9(t):
    return filters.complete_rows(t.props, ["size_sq_ft", "bedrooms", "latitude"]).select("id", "size_sq_ft", "bedrooms")


@query("b10_columns_by_type", "SELECT id, price, latitude, longitude FROM listing", "listing")
def b10(t):
    return t.listing.select(*filters.numeric_columns(t.listing))


@query("b10_text_columns", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def b10_text(t):
    return t.orders.groupBy(*filters.text_columns(t.orders)).agg(F.count(F.lit(1)).alias("n"))


@query("b11_first_rows", "SELECT id, price FROM props ORDER BY id LIMIT 1000", "props")
def b11(t):
    return filters.first_rows(t.props, "id", 1000).select("id", "price")


@query("b12_rename", "SELECT id, price AS asking_price FROM props", "props")
def b12(t):
    return t.props.select("id", "price").withColumnRenamed("price", "asking_price")


@query("b13_empty_guard", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS source, count(*) = 0 AS empty FROM {n}" for n in TABLES) + ")")
def b13(t):
    filters.require_rows(**{n: getattr(t, n) for n in ("orders", "part")})
    parts = [getattr(t, n).agg((F.count(F.lit(1)) == 0).alias("empty")).select(F.lit(n).alias("source"), "empty") for n in TABLES]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
