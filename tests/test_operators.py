"""Operators against plain Python on small frames."""

import datetime as dt
import random
import re
import statistics

import pytest
from pyspark.sql import functions as F

from homematch.operators import encode, impute, joins, metrics, pairs, recommend
from homematch.operators.ranking import exact_medians, exact_quantiles, first_by_key, hash_rank, last_by_key, modes, split_buckets
from homematch.sources import stores


def test_medians_of_hot_groups(spark):
    draw = random.Random(1)
    rows = [("hot", draw.choice([5.0, 7.0, draw.uniform(-3, 1e6)])) for _ in range(600)]
    rows += [("cold", float(v)) for v in range(7)] + [("pair", 1.0), ("pair", 2.0), ("none", None), (None, 9.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(7)
    found = {r.g: r.v for r in exact_medians(df, ["v"], ["g"]).collect()}
    for group in ("hot", "cold", "pair"):
        assert found[group] == statistics.median(v for g, v in rows if g == group)
    assert set(found) == {"hot", "cold", "pair"}
    assert exact_medians(df, ["v"]).first().v == statistics.median(v for _, v in rows if v is not None)
    assert exact_medians(df.where("g = 'none'"), ["v"]).first().v is None


def test_weighted_quantiles(spark):
    df = spark.createDataFrame([(1.0, 3), (2.0, 1), (10.0, 4)], "v double, n int")
    found = {r.point: r.value for r in exact_quantiles(df, ["v"], [0.25, 0.5, 0.75], weight="n").collect()}
    assert found == {0.25: 1.0, 0.5: 6.0, 0.75: 10.0}


@pytest.mark.parametrize("values", [
    [i * 1e-10 for i in range(30_000)], [51.0 + i / 30_000 for i in range(30_000)], [-1e300, 1e300, *[float(i % 5000) for i in range(30_000)]],
])
def test_quantiles_of_crowded_values(spark, values):
    """However close the values lie, no bucket holds more than a hundredth of the different ones."""
    df = spark.createDataFrame([(v, "g") for v in values], "v double, g string").repartition(5)
    counts = df.groupBy("g", F.col("v").alias("value")).agg(F.count("*").alias("n"))
    placed = split_buckets(counts, ["g"])
    held = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high")).orderBy("bucket").collect()
    assert max(r.n for r in held) <= len(set(values)) / 100
    assert all(a.high < b.low for a, b in zip(held, held[1:]))
    ordered = sorted(values)
    found = {r.point: r.value for r in exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0], ["g"]).collect()}
    place = (len(ordered) - 1) * 0.25
    low, part = int(place), place - int(place)
    assert found[0.0] == ordered[0] and found[1.0] == ordered[-1] and found[0.5] == pytest.approx(statistics.median(ordered), rel=1e-12)
    assert found[0.25] == pytest.approx(ordered[low] + (ordered[low + 1] - ordered[low]) * part, rel=1e-12)


def test_hash_ranks_with_small_buckets(spark):
    df = spark.range(300).withColumn("g", F.col("id") % 2)
    few, many = (hash_rank(df, "id", ["g"], rows_per_bucket=n).orderBy("id").collect() for n in (1000, 2))
    assert few == many


def test_ends_by_key(spark):
    rows = [("hot", i, f"v{i}") for i in range(200)] + [("cold", 7, "x"), (None, 3, "n"), (None, 9, "m")]
    df = spark.createDataFrame(rows, "k string, n int, v string").repartition(5)
    assert sorted(map(tuple, first_by_key(df, "k", "n").collect()), key=str) == [("cold", 7, "x"), ("hot", 0, "v0"), (None, 3, "n")]
    assert sorted(map(tuple, last_by_key(df, "k", "n").collect()), key=str) == [("cold", 7, "x"), ("hot", 199, "v199"), (None, 9, "m")]


def test_intervals_cover_what_a_budget_can_pay(spark):
    draw = random.Random(8)
    prices = [draw.choice([-5.0, 0.0, 0.5, 0.75, 1.0, 2.0**40, 2.0**41, draw.uniform(0, 300), float(draw.randint(0, 300))]) for _ in range(150)]
    amounts = sorted({draw.choice([-9.0, -5.0, 0.0, 0.6, 2.0**41, draw.uniform(0, 320), float(draw.randint(0, 300))]) for _ in range(60)})
    market = {c: "x" for c in ("county", "location", "kind")} | {"garden": 0, "parking": 0}
    offers = spark.createDataFrame([{"id": i, "price": p, **market} for i, p in enumerate(prices)])
    budgets = spark.createDataFrame([{"budget": a, **market} for a in amounts])
    held = recommend.in_own_cell(offers).unionByName(recommend.in_intervals(offers, budgets))
    found = [(r.budget, r.id) for r in recommend.affordable(held, budgets).collect()]
    assert len(found) == len(set(found))
    assert set(found) == {(a, i) for a in amounts for i, p in enumerate(prices) if p <= a}


def test_modes(spark):
    df = spark.createDataFrame([("b", None), ("a", None), ("b", None), ("a", None), (None, None)], "t string, e string")
    assert modes(df, ["t", "e"]).first().asDict() == {"t": "a", "e": None}


def test_hash_rank_does_not_depend_on_partitions(spark):
    df = spark.range(500).withColumn("g", F.when(F.col("id") < 400, "hot").otherwise("cold"))
    one, many = (hash_rank(d, "id", ["g"]).orderBy("id").collect() for d in (df.coalesce(1), df.repartition(9)))
    assert one == many
    assert sorted(r["rank"] for r in one if r["g"] == "hot") == list(range(400))
    assert {r["total"] for r in one if r["g"] == "cold"} == {100}


def test_generic_filling(spark):
    df = spark.createDataFrame(
        [(1.0, "A", None, 1), (2.0, "B", None, 2), (None, None, None, 3), (4.0, "D", None, 4), (5.0, "E", None, 5)],
        "n double, t string, e double, f int")
    rows = impute.fill_generic(df).orderBy("f").collect()
    assert rows[2].n == 3.0 and rows[2].t == "A" and all(r.e is None for r in rows)


def test_fill_size_levels(spark):
    df = spark.createDataFrame([
        (1, "Detached", 2, "100 sq ft"), (2, "Detached", 2, "300 sq ft"), (3, "Detached", 2, None), (4, "Detached", 5, None),
        (5, "Other", None, "900 sq ft"), (6, None, None, "40 sq ft"), (7, None, 1, None), (8, "Flat", 1, "x"), (9, "Other", 3, "Size info not available"),
    ], "id int, property_type string, bedrooms int, size string")
    found = {r.id: r.size_sq_ft for r in impute.fill_size(df).collect()}
    after_types = [100, 300, 200, 200, 900, 40, 900]
    assert found == {1: 100.0, 2: 300.0, 3: 200.0, 4: 200.0, 5: 900.0, 6: 40.0, 7: statistics.median(after_types), 8: statistics.median(after_types), 9: 900.0}


def test_flags_sum_to_one(spark):
    df = spark.createDataFrame([("Detached",), ("Flat",), ("Igloo",), (None,)], "k string")
    rows = df.select(*[c.alias(n) for n, c in encode.type_flags(F.col("k")).items()]).collect()
    assert [sum(r) for r in rows] == [1, 1, 1, 1]
    assert rows[1]["property_type_Flat_Maisonette"] == 1 and rows[3]["property_type_Other"] == 1


def test_statistics_reach_every_row(spark):
    df = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"))
    figures = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    found = {r.id: r.n for r in joins.join_statistics(df, figures, ["k"]).collect()}
    assert found == {i: 100 if i % 3 == 0 else 1 for i in range(300)}
    nulls = spark.createDataFrame([(None, 1), ("a", 2), ("b", 3)], "k string, id int")
    held = spark.createDataFrame([(None, 5), ("a", 6)], "k string, n int")
    assert {r.id: r.n for r in joins.join_statistics(nulls, held, ["k"]).collect()} == {1: 5, 2: 6, 3: None}


def test_left_join_present(spark):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "z"), (4, None)], "id int, k string")
    right = spark.createDataFrame([("a", 10), ("", 99)], "k string, v int")
    found = {r.id: r.v for r in joins.left_join_present(left, right, "k").collect()}
    assert found == {1: 10, 2: None, 3: None, 4: None}


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None)], "a double, c double")
    rows = encode.scale(df, encode.fit_scaler(df, ["a", "c"]), ["a", "c"]).orderBy("a").collect()
    assert rows[0].a == pytest.approx(-1.224744871) and rows[0].c == 0.0 and rows[2].c is None


PROPERTIES = [(1, 200000.0, 0), (2, 300000.0, 1), (3, 250000.0, 2)]


def test_pairs_follow_the_tenure_rule(spark):
    properties = spark.createDataFrame(PROPERTIES, "id long, price double, tenure int")
    users = spark.createDataFrame([(1, "Freehold"), (2, "Leasehold"), (3, "No Preference")], "id long, tenure_preference string")
    found = pairs.sample_pairs(properties, users, 2).collect()
    assert len(found) == 4 and len(set(found)) == 4
    assert {r.property_id for r in found if r.user_id == 1} == {1} and {r.property_id for r in found if r.user_id == 2} == {2}
    only_unknown = properties.where("tenure = 2")
    assert pairs.sample_pairs(only_unknown, users, 5).count() == 3
    assert pairs.sample_pairs(properties.where("id < 0"), users, 5).count() == 0


def planned_joins(df, keys):
    """Kind of each planned join on the named keys, before any part of it has run."""
    plan = df._jdf.queryExecution().sparkPlan().toString()
    found = re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin) \[([^\]]*)\]", plan)
    return [kind for kind, at in found if re.sub(r"#\d+L?", "", at) == keys]


def test_pairs_are_merged_however_small_their_files_look(spark):
    properties = spark.range(30).selectExpr("id", "CAST(id % 3 AS INT) AS tenure", "id * 1E0 AS price")
    users = spark.range(20).selectExpr("id", "'Freehold' AS tenure_preference", "id * 2E0 AS income")
    sampled = pairs.sample_pairs(properties, users, 4)
    assert planned_joins(sampled, "pool, rank") == ["SortMergeJoin"]
    rows = pairs.pair_rows(sampled, properties, users)
    assert planned_joins(rows, "property_id") == ["SortMergeJoin"] and planned_joins(rows, "user_id") == ["SortMergeJoin"]
    found = rows.collect()
    assert len(found) == len({(r.user_id, r.property_id) for r in found}) == 80
    assert all(r.tenure == 0 and r.price == r.property_id and r.income == 2 * r.user_id for r in found)


def test_rows_without_a_key_are_spread_and_kept(spark):
    rows = spark.range(400).selectExpr("id", "CASE WHEN id % 4 = 0 THEN id % 3 END AS place")
    found = joins.left_join_present(rows, spark.createDataFrame([(0, "a"), (1, "b"), (None, "c")], "place long, name string"), "place")
    assert {(r.id, r.place, r.name) for r in found.collect()} == {
        (n, *((n % 3, {0: "a", 1: "b"}.get(n % 3)) if n % 4 == 0 else (None, None))) for n in range(400)}
    assert planned_joins(found, "_key, _salt") == ["SortMergeJoin"]


def test_split_is_exact_per_class(spark):
    df = spark.range(1000).withColumn("y", (F.col("id") < 700).cast("int"))
    counts = {(r.y, r.is_test): r["count"] for r in pairs.stratified_split(df, "y", "id").groupBy("y", "is_test").count().collect()}
    assert counts == {(1, 1): 140, (1, 0): 560, (0, 1): 60, (0, 0): 240}


def test_auc_with_ties_and_edges(spark):
    draw = random.Random(3)
    rows = [(draw.randint(0, 1), draw.choice([0.0, 1.0, 0.5, 1e-9, 2e-9, 1 - 1e-9, draw.random()])) for _ in range(400)]
    ones, zeros = [p for y, p in rows if y], [p for y, p in rows if not y]
    wins = sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))
    df = spark.createDataFrame(rows, "y int, probability double")
    assert metrics.roc_auc(df).first().auc == pytest.approx(wins)


def test_scores_without_positives(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, predicted int")
    assert metrics.scores(df).first().asDict() == {"accuracy": 1.0, "precision": 0.0, "recall": 0.0, "f1": 0.0}


def brute_force(profiles, properties, k):
    found = set()
    for u in profiles:
        fit = []
        for p in properties:
            ok = p["price"] <= u["income"] * 4 + u["savings"]
            if u["preferred_county"].lower() in ("oxfordshire", "berkshire"):
                ok &= p["county_" + u["preferred_county"].lower()] == 1
            if u["preferred_location"] in ("Urban", "Rural"):
                ok &= p["location_" + u["preferred_location"]] == 1
            for need in u["must_have_features"]:
                if need in ("Garden", "Parking"):
                    ok &= p["has_" + need.lower()] == 1
            if ok:
                fit.append((-p["property_score"], p["id"]))
        for place, (worth, key) in enumerate(sorted(fit)[:k], start=1):
            if u["profile_score"] - worth > 0:
                found.add((u["id"], place, key))
    return found


@pytest.mark.parametrize("rising", [False, True])
def test_recommendations_match_brute_force(spark, rising):
    """Also where the score rises with the price, so that every property is the best of some budget."""
    draw = random.Random(5)
    properties, profiles = [], []
    for i in range(120):
        price = draw.choice([100000.0, 150000.0, float(draw.randint(1, 400000))])
        properties.append({
            "id": i, "price": price, "property_score": price / 1e5 if rising else draw.choice([0.5, draw.uniform(-2, 2)]),
            "county_oxfordshire": int(i % 3 == 0), "county_berkshire": int(i % 3 == 1), "location_Urban": int(i % 2), "location_Rural": int(i % 4 == 0),
            "property_type_Detached": 1, "has_garden": int(i % 2 == 0), "has_parking": int(i % 5 < 3),
        })
    for i in range(60):
        profiles.append({
            "id": i, "income": float(draw.choice([25000, draw.randint(0, 90000)])), "savings": float(draw.randint(0, 20000)),
            "preferred_county": draw.choice(["Oxfordshire", "Berkshire", "Kent"]), "preferred_location": draw.choice(["Urban", "Rural", "Sea"]),
            "desired_property_type": draw.choice(["Detached", "Castle"]), "must_have_features": draw.choice([["Garden"], ["Parking", "Gym"], [], ["Garden", "Parking"]]),
            "profile_score": draw.uniform(-1, 1),
        })
    left, right = spark.createDataFrame(profiles), spark.createDataFrame(properties)
    found = {(r.user_id, r.position, r.property_id) for r in recommend.recommend(left, right, k=4).collect()}
    assert found == brute_force(profiles, properties, 4)
    eligible = {r.id: r.eligible for r in recommend.eligible_counts(left, right).collect()}
    everything = brute_force([{**p, "profile_score": 1e9} for p in profiles], properties, 10**6)
    assert eligible == {p["id"]: sum(1 for f in everything if f[0] == p["id"]) for p in profiles}


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    incoming = spark.createDataFrame([(2, "x", 1), (2, "y", 2), (3, "z", 1)], "id int, v string, n int")
    once = stores.upsert(target, incoming, "id", "n")
    twice = stores.upsert(once, incoming, "id", "n")
    assert sorted(tuple(r) for r in once.collect()) == [(1, "a"), (2, "y"), (3, "z")] == sorted(tuple(r) for r in twice.collect())


def test_generations_keep_one_backup(spark, tmp_path):
    root = str(tmp_path / "table")
    for n in range(4):
        stores.write_generation(spark.range(n + 1), root, keep=2)
    assert [g.rsplit("=", 1)[1] for g in stores.generations(spark, root)] == ["00000003", "00000004"]
    assert stores.read_generation(spark, root).count() == 4 and stores.read_generation(spark, root, back=1).count() == 3


def test_refresh_from_itself(spark, tmp_path):
    root = str(tmp_path / "self")
    stores.refresh(spark.range(3), root)
    stores.refresh(stores.read_generation(spark, root).union(spark.range(2)), root)
    assert stores.read_generation(spark, root).count() == 5


def test_completeness_gate(spark, tmp_path):
    whole = spark.createDataFrame([(51.5074, -0.1278), (51.5075, -0.1279)], "latitude double, longitude double")
    stores.write_csv(whole, str(tmp_path / "whole.csv"))
    stores.write_csv(whole.union(spark.createDataFrame([(None, 1.0)], whole.schema)), str(tmp_path / "holed.csv"))
    assert stores.file_complete(spark, str(tmp_path / "whole.csv"))
    assert not stores.file_complete(spark, str(tmp_path / "holed.csv"))
    assert not stores.file_complete(spark, str(tmp_path / "absent.csv"))


def test_merge_takes_the_lowest_listing(spark):
    from homematch import schemas

    listing = [{"id": i, "property_url": f"u{i}", "address": a, "price": p, "tenure": t, "property_type": "Flat", "county": "Bedford", "listing_time": "Added today"}
               for i, a, p, t in ((7, "X", 10.0, "Leasehold"), (5, "X", 20.0, "Freehold"), (9, "Y", 30.0, "Unknown"))]
    listings = spark.createDataFrame([[r.get(c) for c in schemas.LISTING.fieldNames()] for r in listing], schemas.LISTING)
    history = [{"id": "a", "price": 0, "postal_code": "X", "property_type": "D", "duration": "U"}, {"id": "b", "price": 5, "postal_code": None, "property_type": "T", "duration": "F", "district": "OXFORD"}]
    registry = spark.createDataFrame([[r.get(c) for c in schemas.HISTORICAL.fieldNames()] for r in history], schemas.HISTORICAL)
    rows = {(r.historical_id, r.listing_id): r for r in joins.merged_rows(registry, listings, dt.date(2024, 1, 31)).collect()}
    assert set(rows) == {("a", 5), ("b", None), (None, 7), (None, 9)}
    assert rows[("a", 5)].price == 20.0 and rows[("a", 5)].tenure == "Freehold" and rows[("a", 5)].county == "bedfordshire"
    assert rows[("b", None)].county == "oxfordshire" and rows[("b", None)].data_source == "historical"
    assert rows[(None, 9)].date == dt.date(2024, 1, 31) and rows[(None, 9)].tenure == "Unknown"


def test_source_dates(spark):
    from homematch.plans.jobs import with_source_date

    df = spark.createDataFrame([("registry", "2023-01-01"), ("scraped", "2023-02-01"), ("registry", "bad")], "source string, old_date string")
    assert [r.Date for r in with_source_date(df, "old_date", dt.date(2023, 5, 1)).collect()] == [dt.date(2023, 1, 1), dt.date(2023, 5, 1), None]
    assert {r.Date for r in with_source_date(df, "absent", dt.date(2023, 5, 1)).collect()} == {dt.date(2023, 5, 1)}


def test_upsert_takes_the_last_row_of_a_key(spark):
    from homematch.sources import stores

    target = spark.createDataFrame([("a", 1), ("c", 9)], "k string, v int")
    load = spark.createDataFrame([("a", 2, 1), ("a", 3, 2), ("b", 5, 4), ("b", 4, 3), (None, 6, 5)], "k string, v int, n int").repartition(3)
    done = stores.upsert(target, load, "k", "n")
    assert sorted(map(tuple, done.collect())) == [("a", 3), ("b", 5), ("c", 9)]
    plan = done._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_second_gazetteer_fills_half_empty_and_repeated_rows(spark):
    from homematch.functions import text


    fields = "address_key string, latitude double, longitude double"
    key = spark.range(1).select(text.address_key(F.lit("1 High Street")).alias("k")).first()["k"]
    primary = spark.createDataFrame([(key, None, 0.5), (key, None, None)], fields)
    secondary = spark.createDataFrame([(key, 51.0, 0.25), (key, 51.0, 0.25)], fields)
    asked = spark.createDataFrame([("1 High Street",)], "address string")
    assert [tuple(r)[1:] for r in joins.coordinates_for(asked, "address", primary, secondary).collect()] == [(51.0, 0.25)]


def test_budgets_are_not_broadcast(spark):
    """Budgets turn into forty rows after the shuffle whose size adaptive execution sees, too many for the driver."""
    market = {c: "x" for c in ("county", "location", "kind")} | {"garden": 0, "parking": 0}
    offers = spark.createDataFrame([{"id": i, "price": float(i), **market} for i in range(50)])
    budgets = spark.createDataFrame([{"budget": float(a), **market} for a in range(40)]).distinct()
    met = recommend.affordable(recommend.in_own_cell(offers).unionByName(recommend.in_intervals(offers, budgets)), budgets)
    assert met.count() == sum(range(1, 41))
    plan = met._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=merge" in plan


def test_flags_by_found_names_keep_every_row(spark):
    df = spark.createDataFrame([(1, "Kent"), (2, None), (3, "Bucks"), (3, "Bucks")], "id int, county string")
    names = encode.county_names(df)
    flags = df.select("id", *[c.alias(n) for n, c in encode.county_flags(F.col("county"), names).items()])
    assert names == ["Bucks", "Kent"]
    assert sorted(map(tuple, flags.collect())) == [(1, 0, 1), (2, 0, 0), (3, 1, 0), (3, 1, 0)]


def test_split_moves_no_rows_and_keeps_its_order(spark):
    """The split of whole ranks, by a filter on a hash and key instead of a sort of all rows."""
    df = spark.range(3000).selectExpr("id", "CASE WHEN id % 7 < 5 THEN 1 WHEN id < 2990 THEN 0 END AS y", "id * 2 AS v").repartition(3)
    ranked = hash_rank(df, "id", by=["y"], seed=42, rank="r", total="n").withColumn("is_test", (F.col("r") < F.round(F.col("n") * 0.2)).cast("int"))
    split = pairs.stratified_split(df, "y", "id")
    assert sorted(map(tuple, split.collect())) == sorted(map(tuple, ranked.select(*split.columns).collect()))
    assert "Window" not in split._jdf.queryExecution().optimizedPlan().toString()


def test_split_is_exact_with_repeated_keys(spark):
    df = spark.range(1000).selectExpr("id % 4 AS id", "id % 2 AS y", "id AS v")
    counts = {(r.y, r.is_test): r["count"] for r in pairs.stratified_split(df, "y", "id").groupBy("y", "is_test").count().collect()}
    assert counts == {(0, 1): 100, (0, 0): 400, (1, 1): 100, (1, 0): 400}
    few = spark.createDataFrame([(1, 0), (2, 0)], "id int, y int")
    assert {r.is_test for r in pairs.stratified_split(few, "y", "id").collect()} == {0}
