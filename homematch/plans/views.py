"""Housing views of the shared test tables.

Each view is a projection of one table written in SQL that Spark and DuckDB
read alike, so a query and its SQL check start from the same rows.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from homematch.lookups import DISTRICT_SHIRES, LISTING_AGE_DAYS, LISTING_TYPES, PROPERTY_CLASSES, SHIRES, type_column

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]

# Day that stands for today in all queries.
AS_OF = "2001-09-01"


def pick(number: str, values: list[str | None]) -> str:
    """Value at a position, as CASE over ``number`` modulo the list length."""
    cases = " ".join(f"WHEN {i} THEN " + ("NULL" if v is None else f"'{v}'") for i, v in enumerate(values))
    return f"CASE CAST({number} % {len(values)} AS INT) {cases} END"


def flag(test: str) -> str:
    return f"CASE WHEN {test} THEN 1 ELSE 0 END"


def thousands(amount: str) -> str:
    return (f"CAST(CAST(floor(({amount}) / 1000) AS BIGINT) AS STRING) || ',' || "
            f"lpad(CAST(({amount}) % 1000 AS STRING), 3, '0')")


def key_text(prefix: str, number: str) -> str:
    return f"'{prefix}' || CAST({number} AS STRING)"


_AMOUNT = "CAST(round(p_retailprice * 300) AS BIGINT) + (p_partkey * 7919) % 200000"
_FEET = "(400 + (p_partkey * 131) % 2600)"
_METRES = "(40 + (p_partkey * 131) % 240)"
_COUNTIES = [
    "BUCKINGHAMSHIRE", "BEDFORD", "OXFORDSHIRE", "NORTH NORTHAMPTONSHIRE", "WEST NORTHAMPTONSHIRE",
    "HERTFORDSHIRE", "WEST BERKSHIRE", "GREATER LONDON", "Oxfordshire",
]
_KINDS = [type_column(c).removeprefix("property_type_") for c in PROPERTY_CLASSES]

# View name to (source table, column to expression).
VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "registry": ("orders", {
        "id": key_text("T", "o_orderkey"),
        "price": "CASE WHEN o_orderkey % 97 = 0 THEN 0 ELSE CAST(floor(o_totalprice) AS BIGINT) END",
        "date_of_transaction": "CAST(o_orderdate AS DATE)",
        "postal_code": f"CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE {key_text('PC', 'o_orderkey % 5000')} END",
        "property_type": pick("o_orderkey", list("DSTFO")),
        "property_age": pick("o_orderkey", list("YNN")),
        "duration": pick("o_orderkey", list("FFFFLLU")),
        "paon": f"CASE WHEN o_orderkey % 11 = 0 THEN 'THE CHAPEL, ' ELSE 'NO ' END || CAST(o_orderkey % 200 + 1 AS STRING)",
        "saon": "CASE WHEN o_orderkey % 6 = 0 THEN 'FLAT \"A\"' ELSE 'MAIN' END",
        "street": key_text("STREET ", "o_custkey % 50"),
        "locality": f"CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE {key_text('AREA ', 'o_custkey % 20')} END",
        "town_city": key_text("TOWN ", "o_custkey % 30"),
        "district": pick("o_custkey", [*DISTRICT_SHIRES, "LUTON", "Harrow", None]),
        "county": pick("o_custkey", _COUNTIES),
        "ppd_category_type": pick("o_orderkey", list("AAAB")),
        "record_status": "CASE WHEN o_orderkey % 101 = 0 THEN 'D' ELSE 'A' END",
    }),
    "listing_raw": ("part", {
        "id": "p_partkey",
        "property_url": key_text("https://homes.example/details/", "p_partkey"),
        "title": "p_name || ' for sale'",
        "address": key_text("PC", "(p_partkey * 3) % 1500"),
        "price": (
            "CASE WHEN p_partkey % 41 = 0 THEN 'Price not available' WHEN p_partkey % 43 = 0 THEN 'POA' "
            f"WHEN p_partkey % 10 = 3 THEN '£' || {thousands(_AMOUNT)} || '.50' "
            f"WHEN p_partkey % 50 = 7 THEN '€ ' || {thousands(_AMOUNT)} ELSE '£' || {thousands(_AMOUNT)} END"
        ),
        "pricing_qualifier": pick("p_partkey", ["Offers over", "Guide price", "Price qualifier not available"]),
        "listing_time": pick("p_partkey", [*LISTING_AGE_DAYS, "3 days ago", "Listing time not available"]),
        "property_type": pick("p_partkey", [*LISTING_TYPES, "Castle", "D"]),
        "bedrooms": "CASE WHEN p_partkey % 37 = 0 THEN 'Bedrooms info not available' ELSE CAST(p_size % 6 AS STRING) || ' bed' END",
        "bathrooms": "CASE WHEN p_partkey % 19 = 0 THEN 'Bathrooms info not available' ELSE CAST(p_size % 4 AS STRING) || 'bath' END",
        "epc_rating": pick("p_partkey", [*[f"EPC rating: {c}*" for c in "ABCDEFG"], "EPC rating not available", "b"]),
        "size": (
            f"CASE WHEN p_partkey % 29 = 0 THEN CAST({_FEET} AS STRING) || 'sqft' ELSE CASE p_size % 6 "
            f"WHEN 0 THEN CAST({_FEET} AS STRING) || ' sq ft' "
            f"WHEN 1 THEN CAST({_METRES} AS STRING) || '.5 sq m' "
            f"WHEN 2 THEN CAST({_FEET} AS STRING) || ' sq ft / ' || CAST({_METRES} AS STRING) || ' sq m' "
            f"WHEN 3 THEN '1,' || lpad(CAST({_FEET} % 1000 AS STRING), 3, '0') || '.25  Sq Ft' "
            "WHEN 4 THEN 'Size info not available' ELSE 'very  spacious' END END"
        ),
        "features": (
            "CASE WHEN p_partkey % 31 = 0 THEN NULL ELSE split(p_name || "
            + pick("p_partkey", [";Tenure: Freehold", ";TENURE: leasehold (95 years remaining)", ";Tenure: ask agent;tenure: Leasehold", ""])
            + " || CASE WHEN p_partkey % 3 = 0 THEN ';Communal Gardens' ELSE '' END"
            + " || CASE WHEN p_partkey % 5 < 2 THEN ';Off-street parking' ELSE '' END, ';') END"
        ),
        "latitude": "CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 5.14E1 + (p_partkey % 100) / 1E2 END",
        "longitude": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE -1.3E0 + (p_partkey % 97) / 1E2 END",
        "county": pick("p_partkey", [*SHIRES, "WEST BERKSHIRE", None]),
    }),
    "users": ("customer", {
        "id": "c_custkey",
        "income": "CAST(30000 + (c_custkey * 7919) % 90000 AS DOUBLE)",
        "savings": "CAST(floor(greatest(c_acctbal, 0E0) * 6) AS DOUBLE)",
        "preferred_location": pick("c_custkey", ["Urban", "Suburban", "Rural"]),
        "desired_property_type": pick("c_custkey", ["Apartment", "House", "Condo"]),
        "must_have_features": pick("c_custkey", ["Garden", "Parking", "Swimming Pool", "Gym", "None"]),
        "nice_to_have_features": pick("c_custkey", ["Balcony", "Fireplace", "Walk-in Closet", "None"]),
        "max_commute_time": "CAST(10 + c_custkey % 50 AS INT)",
        "family_size": "CAST(c_custkey % 5 + 1 AS INT)",
        "tenure_preference": pick("c_custkey", ["Freehold", "Leasehold", "No Preference", "freehold", None, "Commonhold"]),
    }),
    "profiles": ("customer", {
        "id": "c_custkey",
        "income": "CAST(20000 + (c_custkey * 7919) % 90000 AS DOUBLE)",
        "savings": "CAST(floor(greatest(c_acctbal, 0E0) * 3) AS DOUBLE)",
        "preferred_county": pick("c_custkey", [*[s.capitalize() for s in SHIRES], "Kent"]),
        "preferred_location": pick("c_custkey", ["Urban", "Suburban", "Rural", "Urban", "Anywhere"]),
        "desired_property_type": pick("c_custkey + c_nationkey", [*_KINDS, "Castle"]),
        "must_have_features": f"split({pick('c_nationkey', ['Garden', 'Parking;Gym', 'Garden;Parking', 'Swimming Pool'])}, ';')",
        "max_commute_time": "CAST(10 + c_custkey % 50 AS INT)",
        "family_size": "CAST(c_custkey % 5 + 1 AS INT)",
        "tenure_preference": pick("c_custkey", ["FREEHOLD", "LEASEHOLD", "NO_PREFERENCE"]),
        "profile_score": "((c_custkey * 53) % 997) / 997E0 * 3 - 1.5E0",
    }),
    "props": ("part", {
        "id": "p_partkey",
        "price": "CAST(60000 + (p_partkey * 7919) % 500000 AS DOUBLE)",
        "size_sq_ft": "CASE WHEN p_partkey % 13 = 0 THEN NULL ELSE CAST(60 + (p_partkey * 131) % 1200 AS DOUBLE) END",
        "year": "CAST(2020 + p_partkey % 4 AS INT)",
        "month": "CAST(1 + p_partkey % 12 AS INT)",
        "day_of_week": "CAST(p_partkey % 7 AS INT)",
        "price_to_income_ratio": "(60000 + (p_partkey * 7919) % 500000) / 7E4",
        "price_to_savings_ratio": "(60000 + (p_partkey * 7919) % 500000) / 3E4",
        "affordability_score": "3.1E5 / (60000 + (p_partkey * 7919) % 500000)",
        "has_garden": flag("p_partkey % 3 = 0"),
        "has_parking": flag("p_size % 2 = 0"),
        **{f"location_{n}": flag(f"(p_partkey * 7) % 10 {t}") for n, t in (("Urban", "< 4"), ("Suburban", "IN (4, 5, 6)"), ("Rural", "IN (7, 8)"))},
        "latitude": "CASE WHEN p_partkey % 23 = 0 THEN NULL ELSE 5.14E1 + (p_partkey % 100) / 1E2 END",
        "longitude": "-1.3E0 + (p_partkey % 97) / 1E2",
        "epc_rating_encoded": "CAST(p_partkey % 8 AS INT)",
        **{type_column(c): flag(f"p_size % 5 = {i}") for i, c in enumerate(PROPERTY_CLASSES)},
        "bedrooms": "CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(p_size % 4 + 1 AS INT) END",
        "bathrooms": "CAST(p_size % 3 + 1 AS INT)",
        "tenure": "CASE WHEN p_partkey % 5 < 2 THEN 0 WHEN p_partkey % 5 < 4 THEN 1 ELSE 2 END",
        "price_relative_to_county_avg": "5E-1 + (p_partkey % 100) / 1E2",
        **{f"county_{n}": flag(f"p_partkey % 7 = {i}") for i, n in enumerate(SHIRES)},
        "property_score": "((p_partkey * 37) % 1009) / 1009E0 * 4 - 2E0",
    }),
    "judged": ("orders", {
        "id": "o_orderkey",
        "y": flag("(o_orderkey * 7919 + o_custkey) % 100 < 73"),
        "probability": "((o_orderkey * 613 + o_custkey * 7) % 700) / 1E3 + CASE WHEN (o_orderkey * 7919 + o_custkey) % 100 < 73 THEN 3E-1 ELSE 0E0 END",
    }),
    "gazetteer_a": ("customer", {
        "address_key": f"{key_text('PC', 'c_custkey')} || ', UK'",
        "latitude": "5.15E1 + (c_custkey % 90) / 1E2",
        "longitude": "-1.2E0 + (c_custkey % 80) / 1E2",
        "known": "c_acctbal > 3E3",
    }),
    "gazetteer_b": ("customer", {
        "address_key": f"{key_text('PC', 'c_custkey')} || ', UK'",
        "latitude": "5.25E1 + (c_custkey % 90) / 1E2",
        "longitude": "-2E-1 - (c_custkey % 80) / 1E2",
        "known": "c_mktsegment <> 'BUILDING'",
    }),
}

# Views with costly columns over a table whose file, small for its rows, is read
# by few tasks: the key that deals its rows to more of them.
SPREAD = {"listing_raw": "p_partkey"}


class Tables:
    """Test tables and their housing views as lazy DataFrames."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name in TABLES:
            return self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        if name in VIEWS:
            source, columns = VIEWS[name]
            rows = getattr(self, source)
            if name in SPREAD:
                rows = rows.repartition(SPREAD[name])
            return rows.selectExpr(*[f"{e} AS `{c}`" for c, e in columns.items()])
        raise AttributeError(name)

    @cached_property
    def listing(self) -> DataFrame:
        """Listings that can be stored: priced, with their tenure."""
        from homematch.sources.stores import listing_rows, valid_rows

        return valid_rows(listing_rows(self.listing_raw))

    def merge(self) -> DataFrame:
        """Merge of registry and listings, without ids."""
        import datetime as dt

        from homematch.operators.joins import merged_rows
        from homematch.session import saved

        return merged_rows(self.registry, saved(self.listing, "listings"), dt.date.fromisoformat(AS_OF))

    @cached_property
    def merged(self) -> DataFrame:
        """The merge as a stored table."""
        from homematch.session import saved

        return saved(self.merge(), "merged")


def view_sql(name: str) -> str:
    """SELECT that gives a view, for the SQL checks."""
    source, columns = VIEWS[name]
    return "SELECT " + ", ".join(f'{e} AS "{c}"' for c, e in columns.items()) + f" FROM {source}"
