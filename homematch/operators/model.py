"""Suitability classifier and price regression on Spark ML."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Model
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
    MultilayerPerceptronClassificationModel, MultilayerPerceptronClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from homematch import schemas
from homematch.operators.encode import fit_scaler, scale
from homematch.operators.filters import profile_mask
from homematch.operators.pairs import stratified_split
from homematch.operators.ranking import exact_medians, hash_rank
from homematch.operators.recommend import linear_part
from homematch.session import saved

MODELS = {
    "gbt": GBTClassificationModel,
    "logistic": LogisticRegressionModel,
    "perceptron": MultilayerPerceptronClassificationModel,
}


#: Share of the unit matrix that is added to a Gram matrix, so that inputs which add up to a constant can be solved.
RIDGE = 1e-4


@dataclass(frozen=True)
class StoredWeights:
    """Linear classifier kept as a table of weights; the weight without a feature is the intercept."""

    weights: dict[str, float]
    intercept: float = 0.0

    @classmethod
    def read(cls, table: DataFrame) -> StoredWeights:
        """From rows (feature, weight), one for each input."""
        held = {r["feature"]: r["weight"] for r in table.select("feature", "weight").collect()}
        intercept = held.pop(None, 0.0)
        return cls(held, intercept)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([*self.weights.items(), (None, self.intercept)], "feature string, weight double")

    def probability(self, values: Column) -> Column:
        """Probability for an array of inputs in the order of the weights."""
        products = F.zip_with(values, F.array(*[F.lit(float(w)) for w in self.weights.values()]), lambda value, weight: value * weight)
        score = F.aggregate(products, F.lit(float(self.intercept)), lambda total, part: total + part)
        return 1 / (1 + F.exp(-score))


def stored_weights(model: LogisticRegressionModel, features: Sequence[str] = tuple(schemas.MODEL_FEATURES)) -> StoredWeights:
    """Weights of a fitted linear classifier under the names of its inputs."""
    return StoredWeights(dict(zip(features, map(float, model.coefficients.toArray()), strict=True)), float(model.intercept))


def assembled(df: DataFrame, features: Sequence[str] = tuple(f"z_{c}" for c in schemas.MODEL_FEATURES)) -> DataFrame:
    """Vector ``features`` in fixed order; a missing value stops the job."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="error").transform(df)


def validation_split(train: DataFrame, key: str = "pair_id", seed: int = 42) -> DataFrame:
    """Flag ``is_validation`` on a tenth of the training rows."""
    divided = stratified_split(train.drop("is_test"), "y", key, test_share=0.1, seed=seed + 1)
    return divided.withColumn("is_validation", F.col("is_test") == 1)


def with_validation(train: DataFrame, key: str = "pair_id", seed: int = 42) -> DataFrame:
    """Training rows with ``is_validation``, as they are if they were divided before."""
    return train if "is_validation" in train.columns else validation_split(train, key, seed)


def train_classifier(train: DataFrame, kind: str = "gbt", key: str = "pair_id", rounds: int = 40, seed: int = 42) -> Model:
    """Fit a classifier for ``y`` on ``features``.

    Boosted trees stop early on a validation tenth cut from the training rows,
    so the test rows play no part in it; rows that were divided before stay so.
    """
    if kind == "gbt":
        return GBTClassifier(
            labelCol="y", featuresCol="features", maxIter=rounds, maxDepth=5, seed=seed,
            validationIndicatorCol="is_validation", validationTol=0.001,
        ).fit(with_validation(train, key, seed))
    if kind == "logistic":
        return LogisticRegression(labelCol="y", featuresCol="features", maxIter=rounds, regParam=0.001).fit(train)
    if kind == "perceptron":
        width = len(train.select("features").first()[0])
        return MultilayerPerceptronClassifier(labelCol="y", featuresCol="features", layers=[width, 64, 32, 2], maxIter=rounds, seed=seed).fit(train)
    raise ValueError(f"unknown kind of classifier: {kind}")


@dataclass(frozen=True)
class FlatTree:
    """Nodes of one tree as arrays; a leaf is its own child on both sides."""

    feature: np.ndarray
    threshold: np.ndarray
    children: np.ndarray
    prediction: np.ndarray
    depth: int
    #: Left categories of the nodes that ask for one.
    categories: dict[int, np.ndarray]

    @classmethod
    def of(cls, tree) -> FlatTree:
        nodes, categories = [], {}

        def add(node) -> int:
            at = len(nodes)
            nodes.append((0, np.inf, at, at, node.prediction()))
            if node.getClass().getSimpleName() != "LeafNode":
                split = node.split()
                if split.getClass().getSimpleName() == "CategoricalSplit":
                    categories[at], threshold = np.array(list(split.leftCategories())), np.nan
                else:
                    threshold = split.threshold()
                nodes[at] = split.featureIndex(), threshold, add(node.leftChild()), add(node.rightChild()), node.prediction()
            return at

        add(tree._java_obj.rootNode())
        feature, threshold, left, right, prediction = zip(*nodes, strict=True)
        children = np.array([right, left], np.int64).T.reshape(-1)
        return cls(np.array(feature, np.int64), np.array(threshold), children, np.array(prediction), tree.depth, categories)

    def predict(self, inputs: np.ndarray) -> np.ndarray:
        """Predictions for rows of inputs, all rows one level down at a time."""
        at, start = np.zeros(len(inputs), np.int64), np.arange(len(inputs)) * inputs.shape[1]
        values = inputs.reshape(-1)
        for _ in range(self.depth):
            value = values[start + self.feature[at]]
            left = value <= self.threshold[at]
            for node, held in self.categories.items():
                here = at == node
                left[here] = np.isin(value[here], held)
            at = self.children[2 * at + left]
        return self.prediction[at]


def round_figures(model: GBTClassificationModel, rows: DataFrame) -> dict[tuple[bool, int], tuple[float, float]]:
    """Mean log loss and accuracy by ``is_validation`` and round of boosted trees, all in one pass.

    Tasks hand on one sum a round, so the driver gets a few rows of any table.
    """
    trees = [(FlatTree.of(tree), float(weight)) for tree, weight in zip(model.trees, model.treeWeights, strict=True)]
    width = model.numFeatures

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(trees), 2))
        counts = np.zeros(2, np.int64)
        for batch in batches:
            inputs = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, width)
            labels = batch.column(1).to_numpy(zero_copy_only=False)
            held = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            sides = [np.flatnonzero(~held), np.flatnonzero(held)]
            counts += [len(side) for side in sides]
            margin = np.zeros(batch.num_rows)
            for i, (tree, weight) in enumerate(trees):
                margin += weight * tree.predict(inputs)
                loss = 2 * np.logaddexp(0, -2 * (2 * labels - 1) * margin)
                hit = (margin > 0) == labels
                for part, side in enumerate(sides):
                    sums[part, i] += loss[side].sum(), hit[side].sum()
        yield pa.RecordBatch.from_pydict({
            "part": pa.array(np.repeat([0, 1], len(trees)), pa.int32()),
            "round": pa.array(np.tile(np.arange(len(trees)), 2), pa.int32()),
            "loss": sums[:, :, 0].reshape(-1),
            "hits": sums[:, :, 1].reshape(-1),
            "n": pa.array(np.repeat(counts, len(trees)), pa.int64()),
        })

    inputs = rows.select(vector_to_array("features").alias("features"), F.col("y").cast("double").alias("y"), "is_validation")
    found = inputs.mapInArrow(run, "part int, round int, loss double, hits double, n bigint")
    means = found.where("n > 0").groupBy("part", "round").agg((F.sum("loss") / F.sum("n")).alias("loss"), (F.sum("hits") / F.sum("n")).alias("accuracy"))
    return {(bool(r["part"]), r["round"]): (r["loss"], r["accuracy"]) for r in means.collect()}


def training_history(model: Model, train: DataFrame, key: str = "pair_id", seed: int = 42) -> DataFrame:
    """Loss and accuracy per training round, one row per round.

    The validation figures are of the tenth that ``train_classifier`` held back
    for the same key and seed, never of test rows; rows that were divided before
    stay so. Other kinds than boosted trees have the loss alone.
    """
    spark = train.sparkSession
    if isinstance(model, GBTClassificationModel):
        found = round_figures(model, with_validation(train, key, seed))
        rounds = [(found.get((False, i), (None, None)), found.get((True, i), (None, None))) for i in range(len(model.trees))]
        rows = [(i, own[0], held[0], own[1], held[1]) for i, (own, held) in enumerate(rounds, start=1)]
    else:
        rows = [(i, float(v), None, None, None) for i, v in enumerate(model.summary.objectiveHistory)]
    return spark.createDataFrame(rows, "round int, train_loss double, validation_loss double, train_accuracy double, validation_accuracy double")


def scored(model: Model | StoredWeights, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Add ``probability`` of a suitable pair and the ``predicted`` label."""
    if isinstance(model, StoredWeights):
        judged = df.withColumn("probability", model.probability(vector_to_array("features")))
        return judged.withColumn("predicted", (F.col("probability") > threshold).cast("int"))
    out = model.transform(df).withColumn("probability", vector_to_array("probability")[1])
    return out.withColumn("predicted", (F.col("probability") > threshold).cast("int")).drop("rawPrediction", "prediction")


def permutation_importance(model: Model | StoredWeights, df: DataFrame, features: Sequence[str], key: str = "pair_id", seed: int = 7) -> DataFrame:
    """Accuracy lost when one input is swapped between rows, for every input.

    Each row meets a partner, the row at the same rank of a second hash order.
    One scoring pass handles all inputs: a row is repeated per input with that
    value taken from its partner.
    """
    values = F.array(*[F.col(c).cast("double") for c in features])
    ranked = hash_rank(df.select(key, "y", values.alias("own")), key, seed=seed)
    partners = hash_rank(df.select(F.col(key).alias("_partner"), values.alias("other")), "_partner", seed=seed + 1)
    both = ranked.select("rank", "y", "own").join(partners.select("rank", "other"), "rank")
    places = both.withColumn("place", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1))))
    mixed = F.transform("own", lambda v, i: F.when(i == F.col("place"), F.get("other", i)).otherwise(v))
    hits = scored(model, places.withColumn("features", array_to_vector(mixed)))
    accuracy = hits.groupBy("place").agg(F.avg((F.col("predicted") == F.col("y")).cast("double")).alias("accuracy"))
    base = F.max(F.when(F.col("place") == -1, F.col("accuracy"))).over(Window.partitionBy())
    named = accuracy.withColumn("importance", base - F.col("accuracy")).where(F.col("place") >= 0)
    names = F.array(*[F.lit(c) for c in features])
    return named.select(F.get(names, F.col("place")).alias("feature"), "importance")


def save_model(model: Model, scaler: DataFrame, folder: str) -> None:
    """Write a model and its scaler below one folder."""
    model.write().overwrite().save(f"{folder}/model")
    scaler.write.mode("overwrite").parquet(f"{folder}/scaler")


def load_model(spark, folder: str, kind: str = "gbt") -> tuple[Model, DataFrame]:
    """Model and scaler as they were saved."""
    return MODELS[kind].load(f"{folder}/model"), spark.read.parquet(f"{folder}/scaler")


#: Stored property inputs that may be missing; flags count as 0.
MEASURED = ["price", "size_sq_ft", "latitude", "longitude", "bedrooms", "bathrooms", "price_relative_to_county_avg"]


def fill_values(properties: DataFrame) -> DataFrame:
    """Median of each measured input, one row, to be kept with a model."""
    return exact_medians(properties, [c for c in MEASURED if c in properties.columns])


def complete_properties(properties: DataFrame, fill: DataFrame) -> DataFrame:
    """Properties with all model inputs: medians and zeros where missing, and the logarithms."""
    held = {c: v for c, v in fill.first().asDict().items() if v is not None}
    inputs = [c for c in schemas.PROPERTY_FEATURES if c not in ("log_price", "log_size")]
    absent = {c: F.lit(0.0) for c in inputs if c not in properties.columns}
    full = properties.withColumns(absent).na.fill(held).na.fill(0, [c for c in inputs if c not in held])
    return full.withColumns({"log_price": F.log1p("price"), "log_size": F.log1p("size_sq_ft")})


def save_serving(weights: StoredWeights, fill: DataFrame, folder: str) -> None:
    """Write what batch recommendations need beside a model and its scaler."""
    weights.table(fill.sparkSession).coalesce(1).write.mode("overwrite").parquet(f"{folder}/weights")
    fill.write.mode("overwrite").parquet(f"{folder}/fill")


def load_serving(spark: SparkSession, folder: str) -> tuple[StoredWeights, DataFrame]:
    """Weights and fill values as they were saved."""
    return StoredWeights.read(spark.read.parquet(f"{folder}/weights")), spark.read.parquet(f"{folder}/fill")


def serving_scores(
    model: LogisticRegressionModel | StoredWeights, scaler: DataFrame, properties: DataFrame, profiles: DataFrame,
) -> tuple[DataFrame, DataFrame]:
    """``property_score`` and ``profile_score`` of a linear model.

    Both sides are scaled with the stored scaler. Every input belongs to one
    side, so the two parts add up to the log-odds of the pair.
    """
    held = model if isinstance(model, StoredWeights) else stored_weights(model)
    own = [c for c in held.weights if c not in schemas.USER_FEATURES]
    theirs = [c for c in held.weights if c in schemas.USER_FEATURES]

    def part(df: DataFrame, columns: Sequence[str], intercept: float, name: str) -> DataFrame:
        scaled = scale(df, scaler, columns, suffix="_scaled")
        total = linear_part({f"{c}_scaled": held.weights[c] for c in columns}, intercept)
        return scaled.withColumn(name, total).drop(*[f"{c}_scaled" for c in columns])

    return part(properties, own, held.intercept, "property_score"), part(profiles, theirs, 0.0, "profile_score")


def recommend_profile(
    model: Model | StoredWeights, scaler: DataFrame, properties: DataFrame, profile: dict, fill: DataFrame | None = None, k: int = 5, threshold: float = 0.5,
) -> DataFrame:
    """Best ``k`` properties of one profile under any classifier, by ``position``.

    ``profile`` holds plain values with the tenure preference already a code.
    The hard preferences filter first, so only properties in question are scored,
    with the ratios of this buyer as in training. ``fill`` completes properties
    that lack an input. Equal probabilities go by id.
    """
    from homematch.functions.numbers import pair_ratios

    features = list(model.weights) if isinstance(model, StoredWeights) else list(schemas.MODEL_FEATURES)
    kept = properties.where(profile_mask(properties.columns, profile))
    kept = complete_properties(kept, fill) if fill is not None else kept.withColumns({"log_price": F.log1p("price"), "log_size": F.log1p("size_sq_ft")})
    income, savings = F.lit(float(profile["income"])), F.lit(float(profile["savings"]))
    asked = kept.withColumns({c: F.lit(float(profile[c])) for c in schemas.USER_FEATURES})
    asked = asked.withColumns(pair_ratios(F.col("price"), income, savings))
    inputs = scale(asked, scaler, features, suffix="_scaled")
    out = scored(model, assembled(inputs, [f"{c}_scaled" for c in features]), threshold)
    best = out.where(F.col("probability") > threshold).orderBy(F.desc("probability"), "id").limit(k)
    placed = best.withColumn("position", F.row_number().over(Window.orderBy(F.desc("probability"), "id")))
    return placed.drop("features", *[f"{c}_scaled" for c in features])


def moments(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Mean products of every two columns, by one aggregation; the driver sees one number for each pair of columns."""
    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    row = df.agg(*[F.avg(F.col(columns[i]) * F.col(columns[j])).alias(f"m{n}") for n, (i, j) in enumerate(pairs)]).first()
    out = np.zeros((len(columns), len(columns)))
    for n, (i, j) in enumerate(pairs):
        out[i, j] = out[j, i] = row[n] or 0.0
    return out


def price_regression(df: DataFrame, features: Sequence[str], key: str = "id", target: str = "price", kind: str = "linear", seed: int = 42) -> DataFrame:
    """Price estimates for a held-out fifth, on the original scale.

    Inputs and target are scaled with figures of the training rows; the target
    is not among the inputs. The linear kind solves the normal equations of the
    scaled inputs with a small ridge, so one aggregation fits it; ``gbt`` are
    boosted trees.
    """
    if target in features:
        raise ValueError(f"{target} cannot be an input")
    complete = df.na.drop(subset=[*features, target]).select(key, *features, target).withColumn("_all", F.lit(1))
    divided = saved(stratified_split(saved(complete, "complete"), "_all", key, seed=seed).drop("_all"), "divided")
    columns = [*features, target]
    scaler = fit_scaler(divided.where(F.col("is_test") == 0), columns)
    held = scaler.first()
    ready = scale(divided, scaler, columns, suffix="_z")
    train, test = ready.where(F.col("is_test") == 0), ready.where(F.col("is_test") == 1)
    inputs = [f"{c}_z" for c in features]
    if kind == "linear":
        products = moments(train, [*inputs, f"{target}_z"])
        size = len(inputs)
        weights = np.linalg.solve(products[:size, :size] + RIDGE * np.eye(size), products[:size, size])
        judged = test.withColumn("prediction", linear_part(dict(zip(inputs, weights, strict=True))))
    else:
        fitted = GBTRegressor(labelCol=f"{target}_z", featuresCol="features").fit(assembled(train, inputs))
        judged = fitted.transform(assembled(test, inputs))
    estimate = F.col("prediction") * float(held[f"{target}_std"] or 1.0) + float(held[f"{target}_mean"])
    return judged.select(key, target, estimate.alias("estimate"))
