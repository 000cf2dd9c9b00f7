"""Jobs over files, and the classifier."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from homematch.operators import metrics, model
from homematch.plans import jobs
from homematch.schemas import REGISTRY_COLUMNS, REGISTRY_RAW
from homematch.sources import files, stores

FOLDER = "/root/testdata/sf0.001"


def registry_lines():
    places = [("A1", "2023-01-15", "BUCKINGHAMSHIRE"), ("A2", "2022-06-01", "WEST BERKSHIRE"), ("A3", "2023-12-31 23:59", "BUCKINGHAMSHIRE"), ("A4", "2023-02-03", "OXFORDSHIRE")]
    return [f'"{key}","317000","{day}","QX4 4BD","D","Y","F","MILL HOUSE, 8","","LONG LANE","","THAME","SOUTH DOWNLAND","{county}","A","A"' for key, day, county in places]


def test_cleanse_keeps_three_of_four(spark, tmp_path):
    (tmp_path / "raw.csv").write_text("\n".join(registry_lines()))
    counts = jobs.cleanse(spark, str(tmp_path / "raw.csv"), str(tmp_path / "out"), ["Buckinghamshire", "Oxfordshire"], 2023)
    assert [tuple(r) for r in counts.collect()] == [("BUCKINGHAMSHIRE", 2), ("OXFORDSHIRE", 1)]
    assert files.read_registry(spark, str(tmp_path / "raw.csv")).first()["PAON"] == "MILL HOUSE, 8"


def listing(number, price, address="1 Road", features=("Tenure: Leasehold", "Parking")):
    return {
        "id": number, "property_url": f"https://h.example/details/{number}/", "title": "flat", "address": address, "price": price,
        "pricing_qualifier": "Guide price", "listing_time": "Added today", "property_type": "Apartment", "bedrooms": "4 bed", "bathrooms": "3bath",
        "epc_rating": "EPC rating: C*", "size": "452 sq ft / 42 sq m", "features": list(features),
    }


def gazetteer(spark, rows):
    return spark.createDataFrame(rows, "address_key string, latitude double, longitude double")


def test_premerge_resumes(spark, tmp_path):
    source = tmp_path / "property_data_oxfordshire_900000.json"
    source.write_text(json.dumps([listing(1, "£214,500"), listing(2, "Price not available")]))
    registry = tmp_path / "registry.csv"
    registry.write_text("\n".join([",".join(f'"{c}"' for c in REGISTRY_COLUMNS), *registry_lines()]))
    places = (gazetteer(spark, [("1 Road, Buckinghamshire, UK", 51.5, -0.1)]),
              gazetteer(spark, [(f"LONG LANE, THAME, SOUTH DOWNLAND, {c}, UK", 51.8, -0.8) for c in ("BUCKINGHAMSHIRE", "WEST BERKSHIRE", "OXFORDSHIRE")]))
    target = str(tmp_path / "premerged.csv")
    first = jobs.run_premerge(spark, str(source), str(registry), target, places)
    assert first.count() == 6 and stores.file_complete(spark, target)
    found = {r["property_url"] or r["Unique Transaction Identifier"]: r for r in first.collect()}
    assert found["https://h.example/details/1/"]["price"] == 214500.0 and found["https://h.example/details/1/"]["Property Type"] == "F"
    assert found["A1"]["price"] == 317000.0 and str(found["A1"]["Date"])[:10] == "2023-01-15"
    source.write_text("[]")
    assert jobs.run_premerge(spark, str(source), str(registry), target, places).count() == 6


def test_reload_keeps_ids_and_coordinates(spark, tmp_path):
    source = tmp_path / "property_data_oxfordshire_900000.json"
    registry = tmp_path / "registry.csv"
    registry.write_text("\n".join([",".join(f'"{c}"' for c in REGISTRY_COLUMNS), *registry_lines(), registry_lines()[0].replace("A1", "B9").replace('"F"', '"X"')]))
    store, today = str(tmp_path / "store"), dt.date(2024, 1, 31)
    places = (gazetteer(spark, [("1 Road, UK", 51.5, -0.1)]), gazetteer(spark, [("2 Road, UK", 51.6, -0.2)]))
    source.write_text(json.dumps([listing(1, "£100"), listing(2, "POA"), listing(3, "£300", "2 Road")]))
    summary = jobs.run_standardise(spark, store, today, "full", str(registry), [str(source)], gazetteers=places)
    assert {(r.source, r.status): r.n for r in summary.collect()} == {
        ("historical", "processed"): 4, ("historical", "error"): 1, ("listing", "processed"): 2, ("listing", "skipped"): 1}
    before = {r.property_url: (r.id, r.latitude, r.county, r.tenure) for r in stores.read_generation(spark, f"{store}/listing").collect()}
    source.write_text(json.dumps([listing(1, "£150"), listing(4, "£400", "3 Road")]))
    jobs.run_standardise(spark, store, today, "full", str(registry), [str(source)])
    after = {r.property_url: (r.id, r.latitude, r.county, r.tenure) for r in stores.read_generation(spark, f"{store}/listing").collect()}
    assert len(after) == 3 and all(after[k] == v for k, v in before.items())
    assert {v[2] for v in after.values()} == {"oxfordshire"} and len({v[0] for v in after.values()}) == 3
    assert stores.read_generation(spark, f"{store}/merged").count() == 4 + 3
    with pytest.raises(ValueError):
        jobs.run_standardise(spark, store, today, "other")


def test_full_run_fills_stored_listings_and_merged_rows(spark, tmp_path):
    source = tmp_path / "property_data_oxfordshire_900000.json"
    registry = tmp_path / "registry.csv"
    registry.write_text("\n".join([",".join(f'"{c}"' for c in REGISTRY_COLUMNS), *registry_lines()]))
    store, today = str(tmp_path / "store"), dt.date(2024, 1, 31)
    places = (gazetteer(spark, [("1 Road, UK", 51.5, -0.1)]), gazetteer(spark, [("QX4BD, UK", 51.8, -0.8)]))  # the key of QX4 4BD
    source.write_text(json.dumps([listing(1, "£100")]))
    jobs.run_standardise(spark, store, today, "full", str(registry), [str(source)])
    source.write_text(json.dumps([listing(2, "£300", "2 Road")]))
    jobs.run_standardise(spark, store, today, "full", str(registry), [str(source)], gazetteers=places)
    listings = stores.read_generation(spark, f"{store}/listing").collect()
    assert {(r.address, r.latitude, r.longitude) for r in listings} == {("1 Road", 51.5, -0.1), ("2 Road", None, None)}
    merged = stores.read_generation(spark, f"{store}/merged").collect()
    recorded = [(r.latitude, r.longitude) for r in merged if r.data_source == "historical"]
    assert recorded == [(51.8, -0.8)] * 4
    assert {(r.latitude, r.longitude) for r in merged if r.data_source != "historical"} == {(51.5, -0.1), (None, None)}


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")
def test_classifier_learns_the_label(spark):
    from homematch.plans.q_model import training_rows
    from homematch.plans.views import Tables

    train, test, scaler = training_rows(Tables(spark, FOLDER))
    fitted = model.train_classifier(train, "gbt", rounds=10)
    assert metrics.scores(model.scored(fitted, test)).first()["f1"] > 0.8
    assert scaler.count() == 1
