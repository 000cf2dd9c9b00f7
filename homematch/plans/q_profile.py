"""Queries of the counts, distributions, profiles, group figures and top rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from homematch.operators import encode, impute, metrics, profile
from homematch.operators.pairs import labelled_pairs, suitability_conditions
from homematch.operators.ranking import exact_medians, exact_quantiles, modes, top_per_group
from homematch.operators.filters import numeric_columns
from homematch.plans import sqltext as S
from homematch.plans.catalog import query, rounded, whole


@query("d1_rows_per_county", "SELECT county, count(*) AS n FROM registry GROUP BY 1", "registry")
def d1(t):
    return profile.counts_by(t.registry, "county")


@query("d2_coverage", """
    SELECT 'listing' AS source, count(*) AS total, count(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) AS with_coordinates FROM listing
    UNION ALL SELECT 'merged', count(*), count(*) FILTER (latitude IS NOT NULL AND longitude IS NOT NULL) FROM merged""", "listing merged")
def d2(t):
    return profile.coverage(listing=t.listing, merged=t.merged)


@query("d3_average_buyer", "SELECT round(avg(income), 4) AS avg_income, round(avg(savings), 4) AS avg_savings FROM users", "users")
def d3(t):
    from homematch.operators.joins import average_buyer

    return average_buyer(t.users).select(*[rounded(c, 4).alias(c) for c in ("avg_income", "avg_savings")])


_EVENTS_NULLS = "CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END"


@query("d4_median", """
    SELECT median(o_totalprice) AS o_totalprice, CAST(median(o_custkey) AS DOUBLE) AS o_custkey FROM orders""")
def d4(t):
    return exact_medians(t.orders, ["o_totalprice", "o_custkey"])


@query("d4_median_per_group", """
    SELECT l_returnflag, l_linestatus, round(median(l_extendedprice), 4) AS l_extendedprice, round(median(l_quantity), 4) AS l_quantity
    FROM lineitem GROUP BY 1, 2""")
def d4_groups(t):
    found = exact_medians(t.lineitem, ["l_extendedprice", "l_quantity"], ["l_returnflag", "l_linestatus"])
    return found.select("l_returnflag", "l_linestatus", *[rounded(c, 4).alias(c) for c in ("l_extendedprice", "l_quantity")])


def _mode_sql(column: str, table: str) -> str:
    return f"(SELECT CAST({column} AS VARCHAR) FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query("d5_mode", f"SELECT {_mode_sql('district', 'registry')} AS district, {_mode_sql('street', 'registry')} AS street, {_mode_sql('county', 'registry')} AS county", "registry")
def d5(t):
    return modes(t.registry, ["district", "street", "county"])


_REGISTRY_COLUMNS = ["price", "postal_code", "duration", "locality", "district"]


@query("d6_null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing FROM merged"
    for c in ["price", "postal_code", "property_age", "bedrooms", "epc_rating", "latitude", "county", "features"]), "merged")
def d6(t):
    return profile.null_counts(t.merged, ["price", "postal_code", "property_age", "bedrooms", "epc_rating", "latitude", "county", "features"])


@query("d6_null_and_missing_texts", " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({c} IS NULL OR {c} IN ('Size info not available', 'EPC rating not available')) AS missing FROM listing_raw"
    for c in ["size", "epc_rating", "county"]), "listing_raw")
def d6_texts(t):
    return profile.null_counts(t.listing_raw, ["size", "epc_rating", "county"], ["Size info not available", "EPC rating not available"])


def _numeric_sql(columns: list[str], table: str, places: int = 4) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS present, CAST(min({c}) AS DOUBLE) AS minimum, CAST(max({c}) AS DOUBLE) AS maximum, "
        f"round(avg({c}), {places}) AS mean, round(stddev_samp({c}), {places}) AS deviation, round(CAST(median({c}) AS DOUBLE), {places}) AS median FROM {table}"
        for c in columns)


_PROP_NUMBERS = ["price", "size_sq_ft", "bedrooms", "latitude", "price_relative_to_county_avg"]


@query("d7_numeric_profile", _numeric_sql(_PROP_NUMBERS, "props"), "props")
def d7(t):
    found = profile.numeric_profile(t.props, _PROP_NUMBERS)
    return found.select("column", "present", "minimum", "maximum", *[rounded(c, 4).alias(c) for c in ("mean", "deviation", "median")])


@query("d7_numeric_profile_lineitem", _numeric_sql(["l_quantity", "l_extendedprice", "l_discount"], "lineitem", 3))
def d7_lineitem(t):
    found = profile.numeric_profile(t.lineitem, ["l_quantity", "l_extendedprice", "l_discount"])
    return found.select("column", "present", "minimum", "maximum", *[rounded(c, 3).alias(c) for c in ("mean", "deviation", "median")])


def _text_sql(columns: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS present, count(DISTINCT {c}) AS distinct_values, {_mode_sql(c, table)} AS top, "
        f"(SELECT count(*) FROM {table} WHERE CAST({c} AS VARCHAR) = {_mode_sql(c, table)}) AS top_count FROM {table}"
        for c in columns)


@query("d8_text_profile", _text_sql(["street", "district", "duration", "postal_code"], "registry"), "registry")
def d8(t):
    return profile.text_profile(t.registry, ["street", "district", "duration", "postal_code"])


@query("d9_class_distribution", "SELECT y AS label, count(*) AS n, round(count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM judged), 6) AS share FROM judged GROUP BY 1", "judged")
def d9(t):
    return profile.class_distribution(t.judged, "y").select("label", "n", rounded("share").alias("share"))


PAIR_FEATURES = f"""
    joined AS (SELECT p.user_id, p.property_id, h.*, u.income, u.savings, CAST(u.max_commute_time AS DOUBLE) AS max_commute_time,
                      CAST(u.family_size AS DOUBLE) AS family_size, {S.preference('u.tenure_preference')} AS pref,
                      {S.flags_label(S.MARKET_FLAGS['kind'][0], 'property_type_')} AS class
               FROM pairs p JOIN props h ON h.id = p.property_id JOIN users u ON u.id = p.user_id),
    sized AS (SELECT * REPLACE (coalesce(size_sq_ft, (SELECT median(size_sq_ft) FROM joined b WHERE b.class = joined.class)) AS size_sq_ft) FROM joined),
    sized2 AS (SELECT * REPLACE (coalesce(size_sq_ft, (SELECT median(size_sq_ft) FROM sized)) AS size_sq_ft) FROM sized),
    filled AS (SELECT * REPLACE (coalesce(bedrooms, (SELECT median(bedrooms) FROM sized2)) AS bedrooms,
                                 coalesce(latitude, (SELECT median(latitude) FROM sized2)) AS latitude) FROM sized2),
    ready AS (SELECT user_id, property_id, price, size_sq_ft, CAST(bedrooms AS DOUBLE) AS bedrooms, latitude, family_size, pref, tenure,
                     income, savings, max_commute_time, price / (income + 1) AS pir, price / (savings + 1) AS psr, (income * 4 + savings) / (price + 1) AS aff,
                     ln(1 + price) AS log_price, ln(1 + size_sq_ft) AS log_size,
                     aff >= 0.3 AS c1, bedrooms >= family_size * 0.3 AS c2, pir <= 7 AS c3, size_sq_ft >= family_size * 50 AS c4,
                     (tenure = pref OR pref = 2) AS c5, CASE WHEN c1 AND c2 AND c3 AND c4 AND c5 THEN 1 ELSE 0 END AS y,
                     CAST(user_id AS VARCHAR) || '-' || CAST(property_id AS VARCHAR) AS pair_id FROM filled)"""


@query("d10_condition_shares", f"""
    WITH {PAIR_FEATURES} SELECT * FROM (
        SELECT unnest(['affordability', 'bedrooms', 'price_to_income', 'size', 'tenure', 'all']) AS "column",
               unnest([round(avg(c1::INT), 6), round(avg(c2::INT), 6), round(avg(c3::INT), 6), round(avg(c4::INT), 6), round(avg(c5::INT), 6), round(avg(y), 6)]) AS share FROM ready)""",
       "pairs props users")
def d10(t):
    pairs = labelled_pairs(t.props, t.users)
    found = profile.shares(pairs, {**suitability_conditions(), "all": F.col("y") == 1})
    return found.select("column", rounded("share").alias("share"))


@query("d11_distinct_counts", """
    SELECT 'property_id' AS "column", count(DISTINCT property_id) AS distinct_values FROM pairs
    UNION ALL SELECT 'income', count(DISTINCT u.income) FROM pairs p JOIN users u ON u.id = p.user_id""", "pairs users")
def d11(t):
    from homematch.operators.pairs import sample_pairs

    rows = sample_pairs(t.props, t.users).join(t.users.select(F.col("id").alias("user_id"), "income").hint("merge"), "user_id")
    return profile.distinct_counts(rows, ["property_id", "income"])


def _describe_sql(numeric: list[str], texts: list[str], table: str) -> str:
    parts = [
        f"SELECT '{c}' AS \"column\", count({c}) AS present, CAST(min({c}) AS DOUBLE) AS minimum, CAST(max({c}) AS DOUBLE) AS maximum, "
        f"round(avg({c}), 3) AS mean, round(stddev_samp({c}), 3) AS deviation, "
        + ", ".join(f"round(quantile_cont(CAST({c} AS DOUBLE), {p}), 3) AS {n}" for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")))
        + f", NULL AS distinct_values, NULL AS top, NULL AS top_count FROM {table}" for c in numeric]
    parts += [
        f"SELECT '{c}', count({c}), NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(DISTINCT {c}), {_mode_sql(c, table)}, "
        f"(SELECT count(*) FROM {table} WHERE {c} = {_mode_sql(c, table)}) FROM {table}" for c in texts]
    return " UNION ALL ".join(parts)


@query("d12_describe_all", _describe_sql(["o_orderkey", "o_custkey", "o_totalprice"], ["o_orderstatus", "o_orderpriority", "o_orderdate"], "(SELECT * REPLACE (CAST(o_orderdate AS VARCHAR) AS o_orderdate) FROM orders)"))
def d12(t):
    found = profile.describe_all(t.orders)
    figures = ("mean", "deviation", "q25", "q50", "q75")
    return found.select("column", "present", "minimum", "maximum", *[rounded(c, 3).alias(c) for c in figures], "distinct_values", "top", "top_count")


def _unique_sql(columns: list[str], table: str) -> str:
    return " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{c}' AS \"column\", row_number() OVER (ORDER BY v) AS position, v AS value, count(*) OVER () AS total "
        f"FROM (SELECT DISTINCT {c} AS v FROM {table} WHERE {c} IS NOT NULL)) WHERE position <= 10" for c in columns)


@query("d13_unique_values", _unique_sql(["lang", "source"], "documents") + " UNION ALL " + _unique_sql(["district", "street"], "registry"), "registry")
def d13(t):
    documents = profile.unique_values(t.documents, ["lang", "source"])
    return documents.unionByName(profile.unique_values(t.registry, ["district", "street"])).withColumn("position", whole("position"))


@query("d14_shape", "SELECT 'lineitem' AS source, count(*) AS \"rows\", CAST(11 AS BIGINT) AS columns FROM lineitem UNION ALL SELECT 'documents', count(*), 5 FROM documents")
def d14(t):
    parts = [profile.shape(getattr(t, n)).select(F.lit(n).alias("source"), "rows", "columns") for n in ("lineitem", "documents")]
    return parts[0].unionByName(parts[1])


_KEYED = "coalesce(historical_id, 'L' || CAST(listing_id AS STRING))"
SIZED = f"""
    sized AS (SELECT {_KEYED} AS key, property_type, bedrooms, {S.square_feet('size')} AS v FROM merged),
    e1 AS (SELECT s.*, coalesce(s.v, g.m) AS v1 FROM sized s LEFT JOIN (
               SELECT property_type, bedrooms, median(v) AS m FROM sized GROUP BY 1, 2) g ON g.property_type = s.property_type AND g.bedrooms = s.bedrooms),
    e2 AS (SELECT s.*, coalesce(s.v1, g.m) AS v2 FROM e1 s LEFT JOIN (SELECT property_type, median(v1) AS m FROM e1 GROUP BY 1) g ON g.property_type = s.property_type),
    e3 AS (SELECT *, coalesce(v2, (SELECT median(v2) FROM e2)) AS v3 FROM e2)"""


def _sized(t):
    from homematch.functions.text import square_feet

    return t.merged.select(F.expr(_KEYED).alias("key"), "property_type", "bedrooms", square_feet(F.col("size")).alias("size_sq_ft"))


@query("e1_fill_by_type_and_bedrooms", f"WITH {SIZED} SELECT key, round(v1, 4) AS size_sq_ft FROM e1", "merged")
def e1(t):
    filled = impute.fill_group_median(_sized(t), "size_sq_ft", ["property_type", "bedrooms"])
    return filled.select("key", rounded("size_sq_ft", 4).alias("size_sq_ft"))


@query("e2_fill_by_type", f"WITH {SIZED} SELECT key, round(v2, 4) AS size_sq_ft FROM e2", "merged")
def e2(t):
    filled = impute.fill_group_median(_sized(t), "size_sq_ft", ["property_type", "bedrooms"])
    return impute.fill_group_median(filled, "size_sq_ft", ["property_type"]).select("key", rounded("size_sq_ft", 4).alias("size_sq_ft"))


@query("e3_fill_overall", f"WITH sized AS (SELECT {_KEYED} AS key, {S.square_feet('size')} AS v FROM merged) SELECT key, round(coalesce(v, (SELECT median(v) FROM sized)), 4) AS size_sq_ft FROM sized", "merged")
def e3(t):
    return impute.fill_medians(_sized(t), ["size_sq_ft"]).select("key", rounded("size_sq_ft", 4).alias("size_sq_ft"))


@query("e4_relative_price", """
    SELECT id, round(price / avg(price) OVER (PARTITION BY county), 6) AS relative_price FROM registry""", "registry")
def e4(t):
    return encode.relative_price(t.registry, result="relative_price").select("id", rounded("relative_price").alias("relative_price"))


@query("e5_fill_pair_size", f"WITH {PAIR_FEATURES} SELECT user_id, property_id, round(size_sq_ft, 4) AS size_sq_ft FROM ready", "pairs props users")
def e5(t):
    from homematch.operators.pairs import pair_rows, sample_pairs

    rows = pair_rows(sample_pairs(t.props, t.users), t.props, t.users.drop("tenure_preference"))
    return impute.fill_pair_size(rows).select("user_id", "property_id", rounded("size_sq_ft", 4).alias("size_sq_ft"))


@query("f1_top_five_per_buyer", """
    SELECT user_id, position, property_id, price FROM (
        SELECT p.user_id, p.property_id, h.price, row_number() OVER (PARTITION BY p.user_id ORDER BY h.property_score DESC, p.property_id) AS position
        FROM pairs p JOIN props h ON h.id = p.property_id) WHERE position <= 5""", "pairs props")
def f1(t):
    from homematch.operators.pairs import sample_pairs

    scored = sample_pairs(t.props, t.users).join(t.props.select(F.col("id").alias("property_id"), "price", "property_score").hint("merge"), "property_id")
    top = top_per_group(scored, ["user_id"], [F.desc("property_score"), F.col("property_id")], 5)
    return top.select("user_id", whole("position").alias("position"), "property_id", "price")


@query("f1_top_five_per_customer", """
    SELECT o_custkey, position, o_orderkey, o_totalprice FROM (
        SELECT o_custkey, o_orderkey, o_totalprice, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS position FROM orders) WHERE position <= 5""")
def f1_orders(t):
    top = top_per_group(t.orders, ["o_custkey"], [F.desc("o_totalprice"), F.col("o_orderkey")], 5)
    return top.select("o_custkey", whole("position").alias("position"), "o_orderkey", "o_totalprice")


@query("f2_confident_mistakes", """
    WITH w AS (SELECT id, y, probability, abs(probability - 0.5) AS c FROM judged WHERE (probability > 0.5) <> (y = 1)),
    top AS (SELECT * FROM w ORDER BY c DESC, id LIMIT 3)
    SELECT row_number() OVER (ORDER BY c, id DESC) AS sample, id, y, round(probability, 6) AS probability FROM top""", "judged")
def f2(t):
    found = metrics.confident_mistakes(_judged(t), "id")
    return found.select(whole("sample").alias("sample"), "id", "y", rounded("probability").alias("probability"))


def _judged(t):
    return t.judged.withColumn("predicted", (F.col("probability") > 0.5).cast("int"))


_STRONG = ["l_quantity", "l_discount", "l_tax", "l_suppkey", "l_linenumber", "l_partkey"]


@query("f3_strongest_features", f"""
    WITH l AS (SELECT row_number() OVER () AS row, {', '.join(_STRONG)} FROM lineitem),
    t AS (SELECT *, unnest([{', '.join(f"struct_pack(o := {i}, f := '{c}', v := CAST({c} AS DOUBLE))" for i, c in enumerate(_STRONG))}]) AS e FROM l),
    r AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY abs(e.v) DESC, e.o) AS place FROM t)
    SELECT place, e.f AS feature, count(*) AS n, round(sum(e.v), 2) AS total FROM r WHERE place <= 5 GROUP BY 1, 2""")
def f3(t):
    rows = t.lineitem.select(F.posexplode(metrics.strongest_features(_STRONG)).alias("place", "entry"))
    return rows.groupBy((whole("place") + 1).alias("place"), F.col("entry.feature").alias("feature")).agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum("entry.value"), 2).alias("total"))


@query("f4_top_features", """
    SELECT l_suppkey || '' AS feature, round(sum(l_quantity), 2) AS importance FROM lineitem GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15""")
def f4(t):
    weights = t.lineitem.groupBy(F.col("l_suppkey").cast("string").alias("feature")).agg(F.round(F.sum("l_quantity"), 2).alias("importance"))
    return metrics.top_importances(weights)


@query("f5_first_and_last_rows", """
    SELECT 'head' AS part, o_orderkey, o_totalprice FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 5)
    UNION ALL SELECT 'tail', o_orderkey, o_totalprice FROM (SELECT * FROM orders ORDER BY o_orderkey DESC LIMIT 5)""")
def f5(t):
    head = t.orders.orderBy("o_orderkey").limit(5).select(F.lit("head").alias("part"), "o_orderkey", "o_totalprice")
    tail = t.orders.orderBy(F.desc("o_orderkey")).limit(5).select(F.lit("tail").alias("part"), "o_orderkey", "o_totalprice")
    return head.unionByName(tail)
