"""Queries of pairs, labels, evaluation, models and recommendations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from homematch import schemas
from homematch.operators import metrics, model, pairs, profile, recommend
from homematch.operators.joins import one_row
from homematch.plans import sqltext as S
from homematch.plans.catalog import query, rounded, whole
from homematch.plans.jobs import merged_price, recommend_saved, train_and_evaluate
from homematch.plans.q_profile import PAIR_FEATURES
from homematch.session import saved, scratch_path


@query("n1_sample_pairs", "SELECT user_id, property_id FROM pairs", "pairs")
def n1(t):
    return pairs.sample_pairs(t.props, t.users)


@query("n2_label", f"WITH {PAIR_FEATURES} SELECT user_id, property_id, y FROM ready", "pairs props users")
def n2(t):
    return pairs.labelled_pairs(t.props, t.users).select("user_id", "property_id", "y")


_SPLIT = """
    ranked AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY md5('42:' || {key}), {key}) - 1 AS rnk, count(*) OVER (PARTITION BY y) AS n FROM {table}),
    split AS (SELECT *, CASE WHEN rnk < round(n * 0.2) THEN 1 ELSE 0 END AS is_test FROM ranked)"""


@query("n3_stratified_split", f"WITH {_SPLIT.format(key='id', table='judged')} SELECT id, y, is_test FROM split", "judged")
def n3(t):
    return pairs.stratified_split(t.judged, "y", "id").select("id", "y", "is_test")


_READY = {"price": "price", "size_sq_ft": "size_sq_ft", "bedrooms": "bedrooms", "latitude": "latitude", "pir": "price_to_income_ratio",
          "psr": "price_to_savings_ratio", "aff": "affordability_score", "log_price": "log_price", "log_size": "log_size"}


@query("n4_prepare_features", f"""
    WITH {PAIR_FEATURES} SELECT user_id, property_id, {', '.join(f'round({a}, 6) AS {b}' for a, b in _READY.items())}, pref AS tenure_preference, tenure FROM ready""",
       "pairs props users")
def n4(t):
    ready = pairs.labelled_pairs(t.props, t.users)
    return ready.select("user_id", "property_id", *[rounded(c).alias(c) for c in _READY.values()], "tenure_preference", "tenure")


_SCALED = {"price": "price", "income": "income", "aff": "affordability_score", "log_size": "log_size", "family_size": "family_size", "tenure": "tenure"}


@query("n5_scaled_split", f"""
    WITH {PAIR_FEATURES}, {_SPLIT.format(key='pair_id', table='ready')}
    SELECT pair_id, y, is_test, {', '.join(f'round(({a} - (SELECT avg({a}) FROM split WHERE is_test = 0)) / (SELECT stddev_pop({a}) FROM split WHERE is_test = 0), 5) AS z_{b}' for a, b in _SCALED.items())}
    FROM split""", "pairs props users")
def n5(t):
    split, _ = pairs.scaled_split(saved(pairs.labelled_pairs(t.props, t.users), "labelled"))
    return split.select("pair_id", "y", "is_test", *[rounded(f"z_{c}", 5).alias(f"z_{c}") for c in _SCALED.values()])


INPUTS = [f"z_{c}" for c in schemas.MODEL_FEATURES]
#: Rows that one file of the written split holds, so that training, which keeps its rows in memory by file part, is dealt evenly.
ROWS_PER_FILE = 20_000


def training_rows(t) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Assembled training and test pairs, written once, and the scaler."""
    split, scaler = pairs.scaled_split(saved(pairs.labelled_pairs(t.props, t.users), "labelled"))
    ready = model.assembled(saved(split.select("pair_id", "user_id", "property_id", "y", "is_test", *INPUTS), "split", ROWS_PER_FILE))
    return ready.where("is_test = 0"), ready.where("is_test = 1"), scaler


#: Inputs that the SQL tables hold, under their names there.
JUDGED_INPUTS = {
    **{c: c for c in ("price", "size_sq_ft", "bedrooms", "latitude", "tenure", "log_price", "log_size", "income", "savings", "max_commute_time", "family_size")},
    "price_to_income_ratio": "pir", "price_to_savings_ratio": "psr", "affordability_score": "aff", "tenure_preference": "pref",
}
#: Fixed weights, one for each of these inputs, by a rule on its place; SQL reads the same ones.
WEIGHTS = model.StoredWeights({c: ((7 * i) % 11 - 5) / 4 for i, c in enumerate(JUDGED_INPUTS)}, 0.25)


def stored_model(t) -> model.StoredWeights:
    """The fixed weights, written as a table and read back."""
    folder = scratch_path(t.spark, "weights")
    WEIGHTS.table(t.spark).coalesce(1).write.parquet(folder)
    held = model.StoredWeights.read(t.spark.read.parquet(folder))
    return model.StoredWeights({c: held.weights[c] for c in JUDGED_INPUTS}, held.intercept)


def judged_rows(rows: DataFrame) -> DataFrame:
    """Assembled rows with the inputs of the fixed weights alone."""
    return model.assembled(rows.drop("features"), [f"z_{c}" for c in JUDGED_INPUTS])


_Z = ", ".join(f"(CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM split WHERE is_test = 0)) / (SELECT stddev_pop({c}) FROM split WHERE is_test = 0) AS z_{n}" for n, c in JUDGED_INPUTS.items())


def weighted(prefix: str, names=tuple(JUDGED_INPUTS), intercept: float = WEIGHTS.intercept) -> str:
    return " + ".join([f"CAST({intercept} AS DOUBLE)", *[f"{prefix}{c} * CAST({WEIGHTS.weights[c]} AS DOUBLE)" for c in names]])


_TEST = f"WITH {PAIR_FEATURES}, {_SPLIT.format(key='pair_id', table='ready')}, test AS (SELECT * FROM split WHERE is_test = 1)"
#: Least F1 and area under the curve on test rows, and least accuracy on the rows of the training history.
GOOD = 0.97


@query("n6_classifier", f"{_TEST} SELECT count(*) AS test_rows, CAST(sum(y) AS BIGINT) AS positives, TRUE AS good_f1 FROM test", "pairs props users")
def n6(t):
    train, test, _ = training_rows(t)
    judged = saved(model.scored(model.train_classifier(train, "gbt"), test).select("y", "predicted", "probability"), "judged")
    good = one_row(metrics.scores(judged))
    return judged.agg(F.count(F.lit(1)).alias("test_rows"), F.sum("y").alias("positives")).select("test_rows", "positives", (good["f1"] > GOOD).alias("good_f1"))


@query("n7_early_stopping", f"{_TEST} SELECT count(*) AS train_rows, TRUE AS stopped_early FROM split WHERE is_test = 0", "pairs props users")
def n7(t):
    """On labels that say nothing about the inputs, training must stop before its last round."""
    train, _, _ = training_rows(t)
    noise = train.withColumn("y", F.pmod(F.xxhash64("pair_id"), F.lit(2)).cast("int"))
    fitted = model.train_classifier(noise, "gbt", rounds=40)
    return train.agg(F.count(F.lit(1)).alias("train_rows")).select("train_rows", F.lit(fitted.getNumTrees < 40).alias("stopped_early"))


@query("n8_training_history", f"{_TEST} SELECT part, TRUE AS loss_falls, TRUE AS accuracy_rises, TRUE AS good_accuracy FROM (SELECT unnest(['train', 'validation']) AS part)", "pairs props users")
def n8(t):
    """First against last round, on training rows and on the validation tenth."""
    train, _, _ = training_rows(t)
    train = model.validation_split(train)
    history = model.training_history(model.train_classifier(train, "gbt"), train)
    tall = history.select("round", F.explode(F.array(*[
        F.struct(F.lit(p).alias("part"), F.col(f"{p}_loss").alias("loss"), F.col(f"{p}_accuracy").alias("accuracy")) for p in ("train", "validation")])).alias("e"))
    ends = tall.select("round", "e.*").groupBy("part").agg(*[
        f(c, "round").alias(f"{n}_{c}") for n, f in (("first", F.min_by), ("last", F.max_by)) for c in ("loss", "accuracy")])
    return ends.select("part", (F.col("last_loss") < F.col("first_loss")).alias("loss_falls"),
                       (F.col("last_accuracy") >= F.col("first_accuracy")).alias("accuracy_rises"), (F.col("last_accuracy") > GOOD).alias("good_accuracy"))


@query("n9_scored_pairs", f"""
    {_TEST}, z AS (SELECT pair_id, y, {_Z} FROM test)
    SELECT pair_id, y, round(1 / (1 + exp(-({weighted('z_')}))), 6) AS probability, CASE WHEN 1 / (1 + exp(-({weighted('z_')}))) > 0.5 THEN 1 ELSE 0 END AS predicted FROM z""",
       "pairs props users")
def n9(t):
    _, test, _ = training_rows(t)
    judged = model.scored(stored_model(t), judged_rows(test))
    return judged.select("pair_id", "y", rounded("probability").alias("probability"), "predicted")


def _judged(t) -> DataFrame:
    return t.judged.withColumn("predicted", (F.col("probability") > 0.5).cast("int"))


_COUNTS = """
    c AS (SELECT CAST(count(*) FILTER (y = 1 AND probability > 0.5) AS DOUBLE) AS tp, count(*) FILTER (y = 0 AND probability > 0.5) AS fp,
                 count(*) FILTER (y = 1 AND probability <= 0.5) AS fn, CAST(count(*) FILTER (y = 0 AND probability <= 0.5) AS DOUBLE) AS tn FROM judged)"""


@query("n10_scores", f"""
    WITH {_COUNTS} SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy, round(tp / (tp + fp), 6) AS "precision",
           round(tp / (tp + fn), 6) AS recall, round(2 * tp / (2 * tp + fp + fn), 6) AS f1 FROM c""", "judged")
def n10(t):
    return metrics.scores(_judged(t)).select(*[rounded(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")])


@query("n11_confusion_matrix", """
    SELECT y AS actual, count(*) FILTER (probability <= 0.5) AS predicted_0, count(*) FILTER (probability > 0.5) AS predicted_1 FROM judged GROUP BY 1""", "judged")
def n11(t):
    return metrics.confusion_matrix(_judged(t))


@query("n12_classification_report", f"""
    WITH {_COUNTS},
    r AS (SELECT '0' AS class, tn / (tn + fn) AS p, tn / (tn + fp) AS r, 2 * tn / (2 * tn + fn + fp) AS f, tn + fp AS s FROM c
          UNION ALL SELECT '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn FROM c),
    a AS (SELECT * FROM r UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), sum(s) FROM r
          UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), sum(s) FROM r)
    SELECT class, round(p, 6) AS "precision", round(r, 6) AS recall, round(f, 6) AS f1, CAST(s AS BIGINT) AS support FROM a""", "judged")
def n12(t):
    report = metrics.classification_report(_judged(t))
    return report.select("class", *[rounded(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("n13_roc_auc", """
    WITH r AS (SELECT y, rank() OVER (ORDER BY probability) + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS rnk FROM judged)
    SELECT round((sum(rnk) FILTER (y = 1) - CAST(count(*) FILTER (y = 1) AS DOUBLE) * (count(*) FILTER (y = 1) + 1) / 2)
                 / (CAST(count(*) FILTER (y = 1) AS DOUBLE) * count(*) FILTER (y = 0)), 6) AS auc FROM r""", "judged")
def n13(t):
    return metrics.roc_auc(t.judged).select(rounded("auc").alias("auc"))


_SWAPPED = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, avg(CASE WHEN (({weighted('own.z_')} + (other.z_{c} - own.z_{c}) * CAST({WEIGHTS.weights[c]} AS DOUBLE)) > 0) = (own.y = 1) THEN 1.0 ELSE 0.0 END) AS accuracy "
    "FROM swaps own JOIN swaps other ON other.partner = own.place" for c in JUDGED_INPUTS)


@query("n14_permutation_importance", f"""
    {_TEST}, z AS (SELECT pair_id, y, {_Z} FROM test),
    swaps AS (SELECT *, row_number() OVER (ORDER BY md5('7:' || pair_id), pair_id) AS place, row_number() OVER (ORDER BY md5('8:' || pair_id), pair_id) AS partner FROM z),
    base AS (SELECT avg(CASE WHEN ({weighted('z_')} > 0) = (y = 1) THEN 1.0 ELSE 0.0 END) AS accuracy FROM z),
    swapped AS ({_SWAPPED})
    SELECT feature, round(base.accuracy - swapped.accuracy, 6) AS importance FROM swapped, base""", "pairs props users")
def n14(t):
    _, test, _ = training_rows(t)
    found = metrics.top_importances(model.permutation_importance(stored_model(t), saved(judged_rows(test).drop("features"), "judged"), [f"z_{c}" for c in JUDGED_INPUTS]))
    return found.select(F.expr("substr(feature, 3)").alias("feature"), rounded("importance").alias("importance"))


@query("n15_recommendations", """
    SELECT user_id, position, property_id, price, round(1 / (1 + exp(-(profile_score + property_score))), 6) AS probability FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY property_score DESC, property_id) AS position FROM eligible)
    WHERE position <= 5 AND 1 / (1 + exp(-(profile_score + property_score))) > 0.5""", "eligible")
def n15(t):
    found = recommend.recommend(t.profiles, t.props)
    return found.select("user_id", whole("position").alias("position"), "property_id", "price", rounded("probability").alias("probability"))


@query("n15_displayed", f"""
    SELECT user_id, position, property_id, {S.flags_label(S.MARKET_FLAGS['location'][0], 'location_')} AS location, has_garden, has_parking, size_sq_ft FROM (
        SELECT e.user_id, e.property_id, e.profile_score + e.property_score AS s, p.*, row_number() OVER (PARTITION BY e.user_id ORDER BY e.property_score DESC, e.property_id) AS position
        FROM eligible e JOIN props p ON p.id = e.property_id) WHERE position <= 3 AND 1 / (1 + exp(-s)) > 0.6""", "eligible props")
def n15_displayed(t):
    from homematch.functions.text import flag_label

    shown = recommend.displayed(recommend.recommend(t.profiles, t.props, k=3, threshold=0.6), t.props)
    place = flag_label({c: c.removeprefix("location_") for c in schemas.LOCATION_FLAGS})
    return shown.select("user_id", whole("position").alias("position"), "property_id", place.alias("location"), "has_garden", "has_parking", "size_sq_ft")


_OWN = [c for c in JUDGED_INPUTS if c not in schemas.USER_FEATURES]
_THEIRS = [c for c in JUDGED_INPUTS if c in schemas.USER_FEATURES]
_STORED_RATIOS = ["price_to_income_ratio", "price_to_savings_ratio", "affordability_score"]
#: Mean and deviation of each input on training rows, ratios as stored with the property where ``p`` is joined.
_FIGURES = ", ".join(
    f"avg({c}) AS m_{n}, stddev_pop({c}) AS d_{n}" for n, c in ((n, f"p.{n}" if n in _STORED_RATIOS else f"s.{c}") for n, c in JUDGED_INPUTS.items()))
_COMPLETE = """
    whole AS (SELECT * REPLACE (coalesce(size_sq_ft, (SELECT median(size_sq_ft) FROM props)) AS size_sq_ft, coalesce(bedrooms, (SELECT median(bedrooms) FROM props)) AS bedrooms,
                                 coalesce(latitude, (SELECT median(latitude) FROM props)) AS latitude) FROM props),
    complete AS (SELECT *, ln(1 + price) AS log_price, ln(1 + size_sq_ft) AS log_size FROM whole)"""


def scaled_sql(values: dict[str, str]) -> dict[str, str]:
    return {n: f"((CAST({c} AS DOUBLE) - m_{n}) / d_{n})" for n, c in values.items()}


def score_sql(values: dict[str, str], intercept: float) -> str:
    return " + ".join([f"CAST({intercept} AS DOUBLE)", *[f"{z} * CAST({WEIGHTS.weights[n]} AS DOUBLE)" for n, z in scaled_sql(values).items()]])


_PROFILE_CODE = "CASE tenure_preference WHEN 'FREEHOLD' THEN 0 WHEN 'LEASEHOLD' THEN 1 ELSE 2 END"


@query("n15_model_recommendations", f"""
    WITH {PAIR_FEATURES}, {_SPLIT.format(key='pair_id', table='ready')},
    figures AS (SELECT {_FIGURES} FROM split s JOIN props p ON p.id = s.property_id WHERE s.is_test = 0), {_COMPLETE},
    own AS (SELECT c.id, {score_sql({n: f'c.{n}' for n in _OWN}, WEIGHTS.intercept)} AS worth FROM complete c, figures),
    theirs AS (SELECT id, {score_sql({n: _PROFILE_CODE if n == 'tenure_preference' else n for n in _THEIRS}, 0.0)} AS part FROM profiles, figures),
    placed AS (SELECT e.user_id, e.property_id, e.price, o.worth + b.part AS score, row_number() OVER (PARTITION BY e.user_id ORDER BY o.worth DESC, e.property_id) AS position
               FROM eligible e JOIN own o ON o.id = e.property_id JOIN theirs b ON b.id = e.user_id)
    SELECT user_id, position, property_id, price, round(1 / (1 + exp(-score)), 6) AS probability FROM placed WHERE position <= 5 AND 1 / (1 + exp(-score)) > 0.5""",
       "pairs props users profiles eligible")
def n15_model(t):
    """Recommendations as they are served: weights, scaler and fill values saved by training and read back."""
    labelled = saved(pairs.labelled_pairs(t.props, t.users), "labelled")
    stored = labelled.drop(*_STORED_RATIOS).join(t.props.select(F.col("id").alias("property_id"), *_STORED_RATIOS), "property_id")
    _, scaler = pairs.scaled_split(saved(stored, "stored"))
    folder = scratch_path(t.spark, "serving")
    model.save_serving(WEIGHTS, model.fill_values(t.props), folder)
    scaler.write.parquet(f"{folder}/scaler")
    found = recommend_saved(t.spark, folder, t.props.drop("property_score"), t.profiles.drop("profile_score"))
    return found.select("user_id", whole("position").alias("position"), "property_id", "price", rounded("probability").alias("probability"))


_BUYER = {"income": 45000.0, "savings": 12000.0, "max_commute_time": 40, "family_size": 3, "tenure_preference": 2}
_BUYER_RATIOS = {
    "price_to_income_ratio": f"c.price / ({_BUYER['income']} + 1)", "price_to_savings_ratio": f"c.price / ({_BUYER['savings']} + 1)",
    "affordability_score": f"({_BUYER['income']} * 4 + {_BUYER['savings']}) / (c.price + 1)",
}


@query("n15_one_profile", f"""
    WITH {PAIR_FEATURES}, {_SPLIT.format(key='pair_id', table='ready')},
    figures AS (SELECT {', '.join(f'avg({c}) AS m_{n}, stddev_pop({c}) AS d_{n}' for n, c in JUDGED_INPUTS.items())} FROM split WHERE is_test = 0), {_COMPLETE},
    judged AS (SELECT c.id, c.price, {score_sql({n: str(_BUYER[n]) if n in _BUYER else _BUYER_RATIOS.get(n, f'c.{n}') for n in JUDGED_INPUTS}, WEIGHTS.intercept)} AS score
               FROM complete c, figures WHERE c.price <= {_BUYER['income'] * 4 + _BUYER['savings']} AND c.county_oxfordshire = 1 AND c.has_parking = 1)
    SELECT row_number() OVER (ORDER BY 1 / (1 + exp(-score)) DESC, id) AS position, id AS property_id, price, round(1 / (1 + exp(-score)), 6) AS probability
    FROM judged WHERE 1 / (1 + exp(-score)) > 0.3 QUALIFY row_number() OVER (ORDER BY 1 / (1 + exp(-score)) DESC, id) <= 5""", "pairs props users")
def n15_one(t):
    """Best properties of one buyer, whose own ratios are taken."""
    _, _, scaler = training_rows(t)
    buyer = {**_BUYER, "preferred_county": "Oxfordshire", "preferred_location": "Anywhere", "desired_property_type": "Castle", "must_have_features": ["Parking"]}
    found = model.recommend_profile(stored_model(t), scaler, t.props, buyer, model.fill_values(t.props), threshold=0.3)
    return found.select(whole("position").alias("position"), F.col("id").alias("property_id"), "price", rounded("probability").alias("probability"))


@query("n16_prepared_profiles", f"""
    WITH c AS (SELECT id, income, savings, max_commute_time, family_size, CASE tenure_preference WHEN 'FREEHOLD' THEN 0 WHEN 'LEASEHOLD' THEN 1 ELSE 2 END AS tenure_preference FROM profiles),
    u AS (SELECT income, savings, max_commute_time, family_size, {S.preference('tenure_preference')} AS tenure_preference FROM users)
    SELECT id, {', '.join(f'round(({c} - (SELECT avg({c}) FROM u)) / (SELECT stddev_pop({c}) FROM u), 6) AS {c}_scaled' for c in schemas.USER_FEATURES)} FROM c""", "profiles users")
def n16(t):
    from homematch.functions.text import preference_code
    from homematch.operators.encode import fit_scaler

    users = t.users.withColumn("tenure_preference", preference_code(F.col("tenure_preference")))
    prepared = recommend.prepared_profiles(t.profiles, fit_scaler(users, schemas.USER_FEATURES))
    return prepared.select("id", *[rounded(f"{c}_scaled").alias(f"{c}_scaled") for c in schemas.USER_FEATURES])


_WEIGHED = {"a": "(o_totalprice - 250000) / 1E5", "b": "(o_custkey % 17) / 1E1 - 8E-1", "c": "(o_orderkey % 23) / 1E1 - 1E0"}


@query("n17_misclassifications", f"""
    WITH w AS (SELECT j.id, j.y, j.probability, {', '.join(f'CAST({e} AS DOUBLE) AS {n}' for n, e in _WEIGHED.items())} FROM judged j JOIN orders o ON o.o_orderkey = j.id),
    bad AS (SELECT *, abs(probability - 0.5) AS conf FROM w WHERE (probability > 0.5) <> (y = 1)),
    top AS (SELECT * FROM bad ORDER BY conf DESC, id LIMIT 3),
    num AS (SELECT *, row_number() OVER (ORDER BY conf, id DESC) AS sample FROM top),
    tall AS (SELECT *, unnest([{', '.join(f"struct_pack(f := '{n}', v := {n}, o := {i})" for i, n in enumerate(_WEIGHED))}]) AS e FROM num)
    SELECT sample, CAST(id AS VARCHAR) AS key, CASE WHEN y = 1 THEN 'Suitable' ELSE 'Not Suitable' END AS true_label, round(probability, 6) AS probability,
           row_number() OVER (PARTITION BY sample ORDER BY abs(e.v) DESC, e.o) AS place, e.f AS feature, round(e.v, 6) AS value,
           (SELECT count(*) FROM w) AS total, (SELECT count(*) FROM bad) AS misclassified, round((SELECT count(*) FROM bad) / CAST((SELECT count(*) FROM w) AS DOUBLE), 6) AS rate
    FROM tall""", "judged")
def n17(t):
    features = t.orders.selectExpr("o_orderkey AS id", *[f"CAST({e} AS DOUBLE) AS {n}" for n, e in _WEIGHED.items()])
    report = metrics.misclassification_report(_judged(t).join(features, "id"), "id", list(_WEIGHED))
    return report.select(whole("sample").alias("sample"), "key", "true_label", rounded("probability").alias("probability"), whole("place").alias("place"),
                         "feature", rounded("value").alias("value"), "total", "misclassified", rounded("rate").alias("rate"))


_INSPECTED = ", ".join(f"{f'r.{JUDGED_INPUTS[c]}' if c in JUDGED_INPUTS else f'h.{c}'} AS \"{c}\"" for c in schemas.MODEL_FEATURES)


@query("n18_inspection", f"""
    WITH {PAIR_FEATURES}, inspected AS (SELECT r.y, r.pair_id, {_INSPECTED} FROM ready r JOIN props h ON h.id = r.property_id) """ + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (\"{c}\" IS NULL) AS missing, round(CAST(min(\"{c}\") AS DOUBLE), 4) AS minimum, round(CAST(max(\"{c}\") AS DOUBLE), 4) AS maximum, "
    f"round(avg(\"{c}\"), 4) AS mean, round(stddev_samp(\"{c}\"), 4) AS deviation, CAST(NULL AS BIGINT) AS distinct_values, CAST(NULL AS VARCHAR) AS top, "
    f"CAST(sum(y) AS BIGINT) AS positives, round(avg(y), 6) AS ratio FROM inspected" for c in schemas.MODEL_FEATURES)
    + " UNION ALL SELECT 'pair_id', 0, NULL, NULL, NULL, NULL, count(DISTINCT pair_id), min(pair_id), CAST(sum(y) AS BIGINT), round(avg(y), 6) FROM inspected",
       "pairs props users")
def n18(t):
    columns = [*schemas.MODEL_FEATURES, "pair_id"]
    found = profile.inspect(saved(pairs.labelled_pairs(t.props, t.users).select("y", *columns), "inspected"), "y", columns)
    return found.select("column", "missing", *[rounded(c, 4).alias(c) for c in ("minimum", "maximum", "mean", "deviation")],
                        "distinct_values", "top", "positives", rounded("ratio").alias("ratio"))


@query("n19_saved_model", f"{_TEST} SELECT count(*) AS test_rows, TRUE AS same FROM test", "pairs props users")
def n19(t):
    train, test, scaler = training_rows(t)
    folder = scratch_path(t.spark, "model")
    fitted = model.train_classifier(train, "logistic")
    model.save_model(fitted, scaler, folder)
    loaded, _ = model.load_model(t.spark, folder, "logistic")
    before, after = (model.scored(m, test).select("pair_id", F.col("probability").alias(n)) for m, n in ((fitted, "before"), (loaded, "after")))
    return before.join(after, "pair_id").agg(F.count(F.lit(1)).alias("test_rows"), F.bool_and(F.col("before") == F.col("after")).alias("same"))


_HELD = [*schemas.TYPE_FLAGS, "latitude", "longitude", "size_sq_ft", "bedrooms"]


def solved_sql(size: int) -> str:
    """SQL tables that solve a linear system whose rows are in ``g0`` as columns a_i_j, the right side last, by elimination."""
    tables = []
    for k in range(size):
        cells = []
        for i in range(size):
            for j in range(size + 1):
                pivot = f"a_{k}_{j} / a_{k}_{k}"
                cells.append(f"{pivot if i == k else f'a_{i}_{j} - a_{i}_{k} * ({pivot})'} AS a_{i}_{j}")
        tables.append(f"g{k + 1} AS MATERIALIZED (SELECT {', '.join(cells)} FROM g{k})")
    return ", ".join(tables)


_ALL = [*_HELD, "price"]
_SIZE = len(_HELD)


@query("n20_price_regression", f"""
    WITH complete AS (SELECT *, 1 AS y FROM props WHERE {' AND '.join(f'{c} IS NOT NULL' for c in _ALL)}), {_SPLIT.format(key='id', table='complete')},
    z AS MATERIALIZED (SELECT id, is_test, price, {', '.join(f'(CAST({c} AS DOUBLE) - (SELECT avg({c}) FROM split WHERE is_test = 0)) / (SELECT stddev_pop({c}) FROM split WHERE is_test = 0) AS z{i}' for i, c in enumerate(_ALL))} FROM split),
    g0 AS MATERIALIZED (SELECT {', '.join(f"avg(z{i} * z{j}){f' + {model.RIDGE}' if i == j else ''} AS a_{i}_{j}" for i in range(_SIZE) for j in range(_SIZE + 1))} FROM z WHERE is_test = 0),
    {solved_sql(_SIZE)},
    estimates AS (SELECT id, price, (SELECT avg(price) FROM split WHERE is_test = 0) + (SELECT stddev_pop(price) FROM split WHERE is_test = 0) * ({' + '.join(f'a_{i}_{_SIZE} * z{i}' for i in range(_SIZE))}) AS estimate
                  FROM z, g{_SIZE} WHERE is_test = 1)
    SELECT id, price, round(estimate, 3) AS estimate, round(avg(abs(price - estimate)) OVER (), 3) AS mae FROM estimates""", "props")
def n20(t):
    estimated = saved(model.price_regression(t.props, _HELD), "estimates")
    mae = one_row(metrics.regression_errors(estimated, "price", "estimate"))
    return estimated.select("id", "price", rounded("estimate", 3).alias("estimate"), rounded(mae["mae"], 3).alias("mae"))


@query("n21_regression_errors", """
    SELECT round(avg(abs(o_totalprice - e)), 4) AS mae, round(sqrt(avg((o_totalprice - e) * (o_totalprice - e))), 4) AS rmse
    FROM (SELECT o_totalprice, 2.5E5 + (o_custkey % 100) * 1E2 AS e FROM orders)""")
def n21(t):
    estimated = t.orders.withColumn("estimate", F.expr("2.5E5 + (o_custkey % 100) * 1E2"))
    return metrics.regression_errors(estimated, "o_totalprice", "estimate").select(rounded("mae", 4).alias("mae"), rounded("rmse", 4).alias("rmse"))


@query("n22_merged_price", f"""
    SELECT l.id, coalesce({S.price('l.price')}, CAST(r.price AS DOUBLE)) AS price FROM listing_raw l LEFT JOIN registry r ON r.id = 'T' || l.id""", "listing_raw registry")
def n22(t):
    from homematch.functions.text import price_number

    recorded = t.registry.select(F.substring("id", 2, 20).cast("bigint").alias("id"), F.col("price").cast("double").alias("recorded"))
    joined = t.listing_raw.select("id", price_number(F.col("price")).alias("listed")).join(recorded, "id", "left")
    return joined.select("id", merged_price(F.col("listed"), F.col("recorded")).alias("price"))


@query("t4_train_and_evaluate", f"{_TEST} SELECT count(*) AS test_rows, TRUE AS good_f1, TRUE AS good_auc FROM test", "pairs props users")
def t4(t):
    report = train_and_evaluate(t.props, t.users, scratch_path(t.spark, "training"))
    auc, rows = one_row(report["auc"]), one_row(report["confusion"].agg(F.sum(F.col("predicted_0") + F.col("predicted_1")).alias("n")))
    return report["scores"].select(rows["n"].alias("test_rows"), (F.col("f1") > GOOD).alias("good_f1"), (auc["auc"] > GOOD).alias("good_auc"))
