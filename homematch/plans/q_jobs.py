"""Queries of synthetic buyers, stored pages and whole jobs."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from homematch import lookups, schemas
from homematch.operators import profile
from homematch.plans import jobs, sqltext as S
from homematch.plans.catalog import day, query, rounded, whole
from homematch.plans.q_features import merged_with_id
from homematch.plans.q_joins import gazetteers
from homematch.plans.q_stores import listing_files, registry_file, registry_raw
from homematch.plans.views import AS_OF, VIEWS
from homematch.session import scratch_path
from homematch.sources import files, pages, stores, synthetic

TODAY = dt.date.fromisoformat(AS_OF)


def _uniform(draw: str) -> str:
    return f"((CAST('0x' || substr(md5('42:{draw}:' || c_custkey), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)"


def _normal(draw: str, mean: int, deviation: int) -> str:
    return f"round({mean} + {deviation} * sqrt(-2 * ln({_uniform(draw + '-radius')})) * cos(2 * pi() * {_uniform(draw + '-angle')}), 4)"


def _choice(draw: str, options: list[str]) -> str:
    values = ", ".join(f"'{o}'" for o in options)
    return f"[{values}][CAST(floor({_uniform(draw)} * {len(options)}) AS INTEGER) + 1]"


@query("o1_synthetic_buyers", f"""
    SELECT c_custkey AS id, {_normal('income', 70000, 15000)} AS income, {_normal('savings', 30000, 10000)} AS savings,
           {_choice('location', lookups.BUYER_LOCATIONS)} AS preferred_location, {_choice('type', lookups.BUYER_TYPES)} AS desired_property_type,
           {_choice('must', lookups.BUYER_MUST_HAVES)} AS must_have_features, {_choice('nice', lookups.BUYER_NICE_TO_HAVES)} AS nice_to_have_features,
           CAST(floor({_uniform('commute')} * 50) + 10 AS INTEGER) AS max_commute_time, CAST(floor({_uniform('family')} * 5) + 1 AS INTEGER) AS family_size,
           {_choice('tenure', lookups.BUYER_TENURES)} AS tenure_preference FROM customer""")
def o1(t):
    buyers = synthetic.synthetic_buyers(t.customer.select(F.col("c_custkey").alias("id")))
    return buyers.withColumns({"income": rounded("income", 4), "savings": rounded("savings", 4)})


@query("p1_listing_links", """
    SELECT DISTINCT 'https://homes.example' || link AS property_url FROM (
        SELECT unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS link FROM pages) WHERE starts_with(link, '/t')""")
def p1(t):
    return pages.listing_links(t.pages, "https://homes.example", "/t")


@query("p2_next_page", """
    SELECT page_id, CASE WHEN page_id % 3 <> 0 THEN 'https://homes.example/search?page=' || (page_id + 1) END AS next_page FROM pages""")
def p2(t):
    link = F.concat(F.lit('<a class="arrow" title="Next page" href="/search?page='), (F.col("page_id") + 1).cast("string"), F.lit('">next</a>'))
    html = F.concat(F.col("html"), F.when(F.col("page_id") % 3 != 0, link).otherwise(""))
    return t.pages.select("page_id", pages.next_page(html, "https://homes.example").alias("next_page"))


# Where the fields of a listing are found on the test pages.
PAGE_SELECTORS = {"title": ("h1", None), "address": ("div", "ad"), "features_block": ("nav", None), "feature": ("li", None)}


def _plain(html: str) -> str:
    return f"trim(replace(replace(replace({html}, '&quot;', '\"'), '&lt;', '<'), '&amp;', '&'))"


_NAV = r"regexp_extract_all(regexp_extract(html, '(?s)<nav>(.*?)</nav>', 1), '(?s)<li><a [^>]*>(.*?)</a></li>', 1)"


@query("p3_listing_records", rf"""
    SELECT page_id, url AS property_url, {_plain("regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1)")} AS title,
           {_plain("regexp_extract(html, '(?s)<div class=.ad.>(.*?)</div>', 1)")} AS address, 'Price not available' AS price, 'Size info not available' AS size,
           {_plain(f"array_to_string({_NAV}, '|')")} AS features FROM pages""")
def p3(t):
    records = pages.readable_records(pages.listing_records(t.pages, PAGE_SELECTORS))
    return records.select("page_id", "property_url", "title", "address", "price", "size", F.array_join("features", "|").alias("features"))


@query("p4_feature_bullets", f"SELECT page_id, CAST(len({_NAV}) AS INTEGER) AS items, {_plain(f"array_to_string({_NAV}, '|')")} AS bullets FROM pages")
def p4(t):
    html = F.replace(F.col("html"), F.lit("<nav>"), F.lit('<section id="f" class="otm-FeaturesList">'))
    html = F.replace(F.replace(html, F.lit("</nav>"), F.lit("</section>")), F.lit("<li>"), F.lit('<li class="otm-ListItemOtmBullet">'))
    bullets = pages.feature_bullets(html)
    return t.pages.select("page_id", F.size(bullets).alias("items"), F.array_join(bullets, "|").alias("bullets"))


@query("p5_failed_pages", """
    SELECT page_id, url AS property_url, 'empty page' AS error FROM pages WHERE html LIKE '%lang="fr"%'""")
def p5(t):
    holed = t.pages.withColumn("html", F.when(~F.col("html").contains('lang="fr"'), F.col("html")))
    return pages.failed_records(pages.listing_records(holed, PAGE_SELECTORS))


@query("t1_cleanse", """
    SELECT regexp_replace(upper(county), '^(NORTH|WEST) ', '') AS "County", count(*) AS n FROM registry
    WHERE regexp_replace(upper(county), '^(NORTH|WEST) ', '') IN ('BUCKINGHAMSHIRE', 'BEDFORD', 'OXFORDSHIRE', 'NORTHAMPTONSHIRE', 'HERTFORDSHIRE', 'BERKSHIRE')
      AND year(date_of_transaction) = 1999 GROUP BY 1""", "registry")
def t1(t):
    return jobs.cleanse(t.spark, registry_file(t), scratch_path(t.spark, "cleansed"), year=1999)


_COPIED = [c for c in schemas.MERGED.fieldNames() if c not in ("id", "price", "date", "features", "latitude", "longitude")]


@query("t2_standardise_full", f"""
    WITH place AS (SELECT coalesce(a.address_key, b.address_key) AS address_key, coalesce(a.latitude, b.latitude) AS latitude, coalesce(a.longitude, b.longitude) AS longitude
                   FROM (SELECT * FROM gazetteer_a WHERE known) a FULL JOIN (SELECT * FROM gazetteer_b WHERE known) b ON a.address_key = b.address_key)
    SELECT row_number() OVER (ORDER BY md5('0:' || coalesce(historical_id, 'L' || listing_id)), coalesce(historical_id, 'L' || listing_id)) AS id,
           {', '.join(f'm.{c}' for c in _COPIED)}, round(price, 4) AS price, strftime("date", '%Y-%m-%d') AS "date", array_to_string(features, '|') AS features,
           round(place.latitude, 6) AS latitude, round(place.longitude, 6) AS longitude
    FROM merged_loaded m LEFT JOIN place ON place.address_key = m.postal_code || ', UK'""", "merged_loaded gazetteer_a gazetteer_b")
def t2(t):
    store = scratch_path(t.spark, "store")
    jobs.run_standardise(t.spark, store, TODAY, "full", registry_file(t, header=True), [listing_files(t) + "/*"], gazetteers=gazetteers(t), json_lines=True)
    merged = stores.read_generation(t.spark, f"{store}/merged")
    return merged.select("id", *_COPIED, rounded("price", 4).alias("price"), day("date").alias("date"), F.array_join("features", "|").alias("features"),
                         rounded("latitude").alias("latitude"), rounded("longitude").alias("longitude"))


@query("t2_update_geocoding", """
    WITH known AS (SELECT address_key FROM gazetteer_a WHERE known UNION SELECT address_key FROM gazetteer_b WHERE known)
    SELECT 'listing' AS source, count(*) AS total, count(*) FILTER ((l.latitude IS NOT NULL AND l.longitude IS NOT NULL) OR k.address_key IS NOT NULL) AS with_coordinates
    FROM listing l LEFT JOIN known k ON k.address_key = l.address || ', UK'
    UNION ALL
    SELECT 'merged', count(*), count(*) FILTER ((m.latitude IS NOT NULL AND m.longitude IS NOT NULL) OR k.address_key IS NOT NULL)
    FROM merged m LEFT JOIN known k ON k.address_key = m.postal_code || ', UK'""", "gazetteer_a gazetteer_b listing merged")
def t2_geocoding(t):
    store = scratch_path(t.spark, "store")
    stores.write_generation(t.listing, f"{store}/listing")
    stores.write_generation(merged_with_id(t), f"{store}/merged")
    return jobs.run_standardise(t.spark, store, TODAY, "update-geocoding", gazetteers=gazetteers(t))


_SOUND = "id % 11 <> 4"


@query("t2_load_geocoded", f"""
    WITH m AS (SELECT {S.MERGED_ID} AS id, latitude, longitude FROM merged)
    SELECT 'listing' AS source, count(*) FILTER ({_SOUND}) AS total, count(*) FILTER ({_SOUND} AND latitude IS NOT NULL AND longitude IS NOT NULL) AS with_coordinates,
           count(*) FILTER (NOT ({_SOUND})) AS rejected FROM listing
    UNION ALL SELECT 'merged', count(*) FILTER ({_SOUND}), count(*) FILTER ({_SOUND} AND latitude IS NOT NULL AND longitude IS NOT NULL), count(*) FILTER (NOT ({_SOUND})) FROM m""",
       "listing merged")
def t2_load(t):
    """Files in which some rows stand twice, the earlier one without coordinates, and some have no readable id."""
    paths = {}
    for name, rows, schema in (("merged", merged_with_id(t), schemas.MERGED), ("listing", t.listing, schemas.LISTING)):
        paths[name] = scratch_path(t.spark, f"geocoded-{name}")
        own = rows.select(*schema.fieldNames())
        stores.write_csv(own.where(f"id % 5 = 0 AND {_SOUND}").withColumn("latitude", F.lit(None).cast("double")), f"{paths[name]}/1")
        stores.write_csv(own.withColumn("id", F.expr(f"CASE WHEN {_SOUND} THEN CAST(id AS STRING) WHEN id % 2 = 0 THEN 'no ' || id END")), f"{paths[name]}/2")
    files_of = tuple([f"{paths[n]}/1", f"{paths[n]}/2"] for n in ("merged", "listing"))
    return jobs.run_standardise(t.spark, scratch_path(t.spark, "store"), TODAY, "load-geocoded", geocoded=files_of)


_PROCESSED = [c for c in schemas.PROCESSED_COLUMNS if c != "id"] + schemas.COUNTY_FLAGS
_MEASURED = {"price", "size_sq_ft", "year", "month", "day_of_week", "price_to_income_ratio", "price_to_savings_ratio", "affordability_score",
             "latitude", "longitude", "price_relative_to_county_avg", "bedrooms", "bathrooms"}


@query("t3_post_process", f"""
    SELECT id, {', '.join(f'round("{c}", 5) AS "{c}"' if c in _MEASURED else f'CAST("{c}" AS INTEGER) AS "{c}"' for c in _PROCESSED)} FROM processed""", "processed")
def t3(t):
    done = jobs.post_process(merged_with_id(t), t.users, TODAY)
    return done.select("id", *[(rounded(c, 5) if c in _MEASURED else F.col(c).cast("int")).alias(c) for c in _PROCESSED])


@query("t5_premerge", f"""
    WITH r AS (SELECT id AS key, CAST(price AS DOUBLE) AS price, concat_ws(', ', street, nullif(locality, ''), town_city, district, county) AS address, date_of_transaction AS d,
                      property_type AS code, 'registry' AS source FROM registry),
    s AS (SELECT property_url AS key, {S.price('price')} AS price, address || ', Buckinghamshire' AS address, DATE '2023-12-31' AS d,
                 {S.case_of('property_type', lookups.LISTING_TO_REGISTRY)} AS code, 'scraped' AS source FROM listing_raw),
    place AS (SELECT replace(coalesce(a.address_key, b.address_key), ', UK', ', Buckinghamshire, UK') AS address_key, coalesce(a.latitude, b.latitude) AS latitude, coalesce(a.longitude, b.longitude) AS longitude
              FROM (SELECT * FROM gazetteer_a WHERE known) a FULL JOIN (SELECT * FROM gazetteer_b WHERE known) b ON a.address_key = b.address_key)
    SELECT source, key, price, address, strftime(d, '%Y-%m-%d') AS "date", code, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
    FROM (SELECT * FROM r UNION ALL SELECT * FROM s) m LEFT JOIN place p ON p.address_key = m.address || ', UK'""", "registry listing_raw gazetteer_a gazetteer_b")
def t5(t):
    places = tuple(g.withColumn("address_key", F.replace("address_key", F.lit(", UK"), F.lit(", Buckinghamshire, UK"))) for g in gazetteers(t))
    merged = jobs.premerge(t.listing_raw.drop("latitude", "longitude", "county"), registry_raw(t), places)
    return merged.select(
        "source", F.coalesce("`Unique Transaction Identifier`", "property_url").alias("key"), "price", F.col("normalized_address").alias("address"),
        day("Date").alias("date"), F.col("Property Type").alias("code"), rounded("latitude").alias("latitude"), rounded("longitude").alias("longitude"),
    )


_EXPLORED = list(VIEWS["registry"][1])
_PLAIN = [c for c in _EXPLORED if c != "price"]
_AS_TEXT = {c: f"CAST({c} AS VARCHAR)" for c in _EXPLORED}


def _end_rows(part: str, order: str) -> str:
    return (f"SELECT '{part}' AS part, \"column\", value FROM (SELECT unnest({_EXPLORED}) AS \"column\", unnest([{', '.join(_AS_TEXT.values())}]) AS value "
            f"FROM (SELECT * FROM registry ORDER BY id {order} LIMIT 5))")


@query("t6_exploration", " UNION ALL ".join([
    _end_rows("head", ""), _end_rows("tail", "DESC"),
    *[f"SELECT 'columns', '{c}', '{dict(price='bigint', date_of_transaction='date').get(c, 'string')}'" for c in _EXPLORED],
    "SELECT 'description', 'price', concat_ws('|', count(price), min(price), max(price), CAST(round(avg(price) * 100) AS BIGINT), CAST(median(price) * 2 AS BIGINT)) FROM registry",
    *[f"SELECT 'description', '{c}', concat_ws('|', count({c}), count(DISTINCT {c}), (SELECT v || '|' || n FROM (SELECT {_AS_TEXT[c]} AS v, count(*) AS n FROM registry WHERE {c} IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1))) FROM registry" for c in _PLAIN],
    *[f"SELECT 'unique', '{c}', v FROM (SELECT DISTINCT {_AS_TEXT[c]} AS v FROM registry WHERE {c} IS NOT NULL ORDER BY 1 LIMIT 10)" for c in _PLAIN if c != "date_of_transaction"],
]), "registry")
def t6(t):
    report = jobs.explore(t.registry, "id")
    parts = []
    for name in ("head", "tail"):
        texts = report[name].select(*[F.col(c).cast("string").alias(c) for c in _EXPLORED])
        parts.append(texts.unpivot([], _EXPLORED, "column", "value").select(F.lit(name).alias("part"), "column", "value"))
    parts.append(report["columns"].select(F.lit("columns").alias("part"), "column", F.col("type").alias("value")))
    numbers = [whole("minimum"), whole("maximum"), whole(F.round(F.col("mean") * 100)), whole(F.col("q50") * 2)]
    figures = F.when(F.col("column") == "price", F.concat_ws("|", "present", *numbers)).otherwise(F.concat_ws("|", "present", "distinct_values", "top", "top_count"))
    parts.append(report["description"].select(F.lit("description").alias("part"), "column", figures.alias("value")))
    parts.append(report["unique"].select(F.lit("unique").alias("part"), "column", "value"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
