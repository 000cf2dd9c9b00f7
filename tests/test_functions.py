"""Exact values of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from homematch.functions import arrays, dates, numbers, text


def apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


CASES = {
    "price": (text.price_number, {
        "£300,000": 300000.0, "€250,000.50": 250000.5, "300000": 300000.0, "Invalid": None, "Price Not Available": None,
        "1d": None, None: None, " £ 1,5.5": 15.5,
    }),
    "epc": (text.epc_letter, {"A": "A", "b": "B", "EPC Rating: C": "C", "Not Rated": None, None: None, "EPC rating: E*": "E"}),
    "number": (text.first_number, {"3 bedrooms": 3, "Bath: 2": 2, "no digits": None, None: None, "0 bed": 0}),
    "size": (text.size_text, {
        "1500 sq ft": "1500 sq ft / 139 sq m", "150 sq m": "1615 sq ft / 150 sq m",
        "1,500 sq ft / 139.35 sq m": "1500 sq ft / 139 sq m", "2,000 sq ft": "2000 sq ft / 186 sq m",
        "1,234.56 sq ft": "1235 sq ft / 115 sq m", "1,000,000 sq ft": "1000000 sq ft / 92903 sq m",
        "Invalid size": "Invalid size", None: None, "1000sqft": "10764 sq ft / 1000 sq m",
    }),
    "feet": (text.square_feet, {"1000 sq ft": 1000.0, "1,234 sq ft": 234.0, "Size info not available": None, None: None, "12.5 sq ft": 12.5}),
    "address": (text.address_key, {
        "  123 Main St., City, @UK!!  ": "123 Main St, City, UK", "1 Road, United Kingdom": "1 Road, United Kingdom",
        "1 Road": "1 Road, UK", "a,,b": "a, b, UK", "Rue Café": "Rue Café, UK", "Crescent the": "Crescenthe, UK", None: None,
    }),
    "with shire": (text.with_shire, {"1 Road": "1 Road, Buckinghamshire", "Buckinghamshire Way ": "Buckinghamshire Way"}),
    "county": (text.cleansed_county, {"North Northamptonshire": "NORTHAMPTONSHIRE", "WEST BERKSHIRE": "BERKSHIRE", "Northolt": "NORTHOLT", None: None}),
    "shire": (text.shire, {"Vale of White Horse": "oxfordshire", "BEDFORD": "bedfordshire", "Luton": "luton", None: None}),
    "class": (text.property_class, {
        "D": "Detached", "S": "Semi-Detached", "T": "Terraced", "F": "Flat/Maisonette", "O": "Other", "Apartment": "Flat/Maisonette",
        "Bungalow": "Detached", "Semi-detached house": "Semi-Detached", "Terraced house": "Terraced", "Barn": "Other", "Igloo": "Other", None: "Other",
    }),
    "registry code": (text.registry_code, {"Semi-detached bungalow": "D", "Townhouse": "D", "Castle": None, None: None}),
    "preference": (text.preference_code, {"Freehold": 0, "LEASEHOLD": 1, "No Preference": 2, "other": 2, None: 2}),
    "tenure code": (text.tenure_code, {"Freehold": 0, "Leasehold": 1, "Unknown": 2, None: 2}),
    "epc code": (text.epc_code, {"G": 1, "A": 7, "Unknown": 0, None: 0}),
    "number or null": (numbers.number_or_null, {"1.5": 1.5, " -2 ": -2.0, "x": None, "1d": None, "NaN": None, None: None}),
    "date": (dates.parsed_date, {"2023-01-15": dt.date(2023, 1, 15), "": None, "2023-13-01": None, None: None}),
}


@pytest.mark.parametrize("name", CASES)
def test_exact_values(spark, name):
    function, cases = CASES[name]
    assert apply(spark, function, list(cases)) == list(cases.values())


def test_word_bounded_address(spark):
    assert apply(spark, lambda c: text.address_key(c, word_bounded=True), ["Crescent the", "York York"]) == ["Crescent the, UK", "York, UK"]


def test_tenure_of_features(spark):
    cases = [["Tenure: Freehold"], ["x", "TENURE: leasehold (95 years)"], ["Tenure: ask", "tenure: Freehold"], ["Garden"], [], None]
    assert apply(spark, text.tenure_of, cases, "array<string>") == ["Freehold", "Leasehold", "Freehold", "Unknown", "Unknown", "Unknown"]


def test_mentions(spark):
    cases = [["Communal Gardens"], ["Parking"], [], None]
    assert apply(spark, lambda c: arrays.mentions(c, "garden"), cases, "array<string>") == [True, False, False, False]


def test_preference_number(spark):
    assert apply(spark, text.preference_number, [0.0, 1.0, 2.0, None], "double") == [0, 1, 2, 2]


def test_listing_dates(spark):
    labels = ["Added today", "Added < 7 days", "Reduced < 14 days", "3 days ago", None]
    found = apply(spark, lambda c: dates.listing_date(c, dt.date(2024, 3, 31)), labels)
    assert [(dt.date(2024, 3, 31) - d).days for d in found] == [0, 3, 17, 60, 60]


def test_recency(spark):
    days = [-1, 0, 1, 2, 7, 8, 14, 30, 60, 61]
    expected = [None, None, "Today", "Last Week", "Last Week", "Last 2 Weeks", "Last 2 Weeks", "Last Month", "Last 2 Months", "Older"]
    assert apply(spark, dates.recency_class, days, "int") == expected


def test_price_segments(spark):
    df = spark.range(1).select(F.inline(numbers.price_segments(F.lit(250000), 100000)))
    assert [(r.min_price, r.max_price) for r in df.orderBy("segment").collect()] == [(0, 100000), (100001, 200001), (200002, 250000)]
    placed = apply(spark, lambda c: numbers.price_segment(c, 100000), [0.0, 100000.0, 100001.0, 200001.0, 200002.0], "double")
    assert placed == [0, 0, 1, 1, 2]


def test_location_class(spark):
    df = spark.createDataFrame(
        [(1, 51.63, -0.75, "Buckinghamshire"), (2, 51.70, -0.75, "buckinghamshire"), (3, 53.0, 0.0, "oxfordshire"), (4, 51.63, -0.75, "kent"), (5, None, 0.0, "oxfordshire")],
        "i int, a double, o double, c string")
    found = df.orderBy("i").select(numbers.location_class(numbers.centre_distance(F.col("a"), F.col("o"), F.col("c"))))
    assert [r[0] for r in found.collect()] == ["Urban", "Suburban", "Rural", None, None]


def test_parsed_lists(spark):
    assert apply(spark, arrays.parsed_list, ['["a","b"]', "['a']", "[x", None]) == [["a", "b"], None, None, None]
    assert apply(spark, lambda c: arrays.parsed_list(c, single_quoted=True), ["['a', 'b']"]) == [["a", "b"]]
