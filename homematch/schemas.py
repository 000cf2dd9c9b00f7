"""Schemas and column lists of the stored tables."""

from __future__ import annotations

from pyspark.sql import types as T

from homematch.lookups import LOCATION_CLASSES, PROPERTY_CLASSES, SHIRES, type_column

S, L, I, D = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType()
STRINGS = T.ArrayType(T.StringType())


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Column order of the headerless registry file.
REGISTRY_COLUMNS = [
    "Unique Transaction Identifier",
    "Price",
    "Date of Transaction",
    "Postal Code",
    "Property Type",
    "Old/New",
    "Duration",
    "PAON",
    "SAON",
    "Street",
    "Locality",
    "Town/City",
    "District",
    "County",
    "PPD Category Type",
    "Record Status",
]

REGISTRY_RAW = T.StructType([T.StructField(c, L if c == "Price" else S) for c in REGISTRY_COLUMNS])

HISTORICAL = _struct(
    id=S, price=L, date_of_transaction=T.DateType(), postal_code=S, property_type=S, property_age=S,
    duration=S, paon=S, saon=S, street=S, locality=S, town_city=S, district=S,
    ppd_category_type=S, record_status=S,
)

LISTING_RAW = _struct(
    id=L, property_url=S, title=S, address=S, price=S, pricing_qualifier=S, listing_time=S,
    property_type=S, bedrooms=S, bathrooms=S, epc_rating=S, size=S, features=STRINGS,
)

LISTING = _struct(
    id=L, property_url=S, title=S, address=S, price=D, pricing_qualifier=S, listing_time=S,
    property_type=S, bedrooms=S, bathrooms=S, epc_rating=S, size=S, features=STRINGS,
    latitude=D, longitude=D, tenure=S, county=S,
)

MERGED = _struct(
    id=L, historical_id=S, listing_id=L, price=D, postal_code=S, property_type=S, date=T.DateType(),
    property_age=S, tenure=S, bedrooms=L, bathrooms=L, epc_rating=S, size=S, features=STRINGS,
    data_source=S, listing_time=S, latitude=D, longitude=D, county=S,
)

USERS = _struct(
    id=L, income=D, savings=D, preferred_location=S, desired_property_type=S, must_have_features=S,
    nice_to_have_features=S, max_commute_time=I, family_size=I, tenure_preference=S,
)

# Closed value domains of the coded columns.
DOMAINS = {
    "property_type": ["D", "S", "T", "F", "O"],
    "property_age": ["Y", "N"],
    "duration": ["F", "L"],
    "ppd_category_type": ["A", "B"],
    "record_status": ["A", "D"],
}

AMENITY_FLAGS = ["has_garden", "has_parking"]
LOCATION_FLAGS = [f"location_{name}" for name in LOCATION_CLASSES]
TYPE_FLAGS = [type_column(name) for name in PROPERTY_CLASSES]
COUNTY_FLAGS = [f"county_{name}" for name in SHIRES]
FLAGS = AMENITY_FLAGS + LOCATION_FLAGS + TYPE_FLAGS

# Property inputs of the model in their order.
PROPERTY_FEATURES = [
    "price", "size_sq_ft", "year", "month", "day_of_week",
    "price_to_income_ratio", "price_to_savings_ratio", "affordability_score",
    "has_garden", "has_parking",
    "location_Urban", "location_Suburban", "location_Rural",
    "latitude", "longitude", "epc_rating_encoded",
    "property_type_Detached", "property_type_Semi_Detached", "property_type_Terraced", "property_type_Flat_Maisonette", "property_type_Other",
    "bedrooms", "bathrooms", "tenure", "price_relative_to_county_avg",
    "county_buckinghamshire", "county_bedfordshire", "county_hertfordshire", "county_oxfordshire", "county_berkshire", "county_northamptonshire",
    "log_price", "log_size",
]
# Buyer inputs of the model in their order.
USER_FEATURES = ["income", "savings", "max_commute_time", "family_size", "tenure_preference"]
MODEL_FEATURES = PROPERTY_FEATURES + USER_FEATURES

# Stored features, in order, before the county flags are added.
PROCESSED_COLUMNS = ["id"] + [c for c in PROPERTY_FEATURES if c not in COUNTY_FLAGS + ["log_price", "log_size"]]
