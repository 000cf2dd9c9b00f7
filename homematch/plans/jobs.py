"""Whole jobs over stored files and tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from homematch import schemas
from homematch.functions import dates, text
from homematch.lookups import CLEANSE_TARGETS
from homematch.operators import encode, impute, joins, metrics, model, pairs, profile, recommend
from homematch.operators.filters import require_rows, shires_in_year
from homematch.operators.unions import stacked
from homematch.session import saved
from homematch.sources import files, stores


def cleanse(
    spark: SparkSession, source: str, target: str, targets: Sequence[str] = tuple(CLEANSE_TARGETS), year: int = 2023,
) -> DataFrame:
    """Keep one year of the target shires of a registry file; returns rows per county."""
    raw = files.read_registry(spark, source)
    dated = raw.withColumn("Date of Transaction", dates.parsed_timestamp(F.col("Date of Transaction")))
    kept = shires_in_year(dated, "County", "Date of Transaction", targets, year)
    written = kept.withColumn("Date of Transaction", F.date_format("Date of Transaction", "yyyy-MM-dd HH:mm:ss"))
    stores.write_csv(written, target)
    return profile.counts_by(files.read_csv(spark, target, _as_text(written)), "County")


def _as_text(df: DataFrame):
    from pyspark.sql import types as T

    return T.StructType([T.StructField(c, T.StringType()) for c in df.columns])


def standardise(
    historical: DataFrame, listings: DataFrame, as_of: dt.date,
    gazetteers: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Merged table of stored registry rows and listings.

    Gazetteers, where given, fill the coordinates of merged rows by postal code;
    without them that is skipped.
    """
    merged = joins.with_merged_ids(joins.merged_rows(historical, listings, as_of))
    return joins.fill_coordinates(merged, "postal_code", *gazetteers) if gazetteers else merged


def run_standardise(
    spark: SparkSession, store: str, as_of: dt.date, mode: str = "full", registry: str | None = None,
    listing_files: list[str] | None = None, geocoded: tuple[str | list[str], str | list[str]] | None = None,
    gazetteers: tuple[DataFrame, DataFrame] | None = None, json_lines: bool = False,
) -> DataFrame:
    """Load the stored tables in one of three modes and return the load summary or coverage.

    ``full`` upserts a registry file and listing files and rebuilds the merged
    table; gazetteers, where given, fill the coordinates of all stored listings
    by address and of the merged rows left by postal code. ``update-geocoding`` fills coordinates of the stored tables only.
    ``load-geocoded`` upserts pre-geocoded merged and listing files by id.

    Of several rows of one key the last counts, by file and place in the file.
    Rows that cannot be stored are kept below ``rejected`` with their reason, in
    the types of their table, and counted in the summary or the coverage.
    """
    def current(name: str, schema) -> DataFrame:
        found = stores.generations(spark, f"{store}/{name}")
        return files.read_table(spark, found[-1]) if found else spark.createDataFrame([], schema)

    def save(name: str, df: DataFrame) -> DataFrame:
        return files.read_table(spark, stores.write_generation(df, f"{store}/{name}"))

    if mode == "update-geocoding":
        listings, merged = joins.backfill_coordinates(
            current("listing", schemas.LISTING), current("merged", schemas.MERGED), *gazetteers)
        return profile.coverage(listing=save("listing", listings), merged=save("merged", merged))
    if mode == "load-geocoded":
        merged_file, listing_file = geocoded
        loaded, rejected = {}, {}
        for name, path, schema, quoted in (
            ("merged", merged_file, schemas.MERGED, False), ("listing", listing_file, schemas.LISTING, True),
        ):
            raw = files.read_csv_with_nulls(spark, path, schema.fieldNames(), with_order=True)
            rows = saved(stores.geocoded_rows(raw, {f.name: f.dataType.simpleString() for f in schema.fields}, quoted), f"load-{name}")
            loaded[name] = save(name, stores.upsert(current(name, schema), stores.valid_rows(rows), "id", files.ORDER))
            rejected[name] = save(f"rejected/{name}", stores.quarantined_rows(rows))
        counts = stacked(*[d.agg(F.count("*").alias("rejected")).withColumn("source", F.lit(n)) for n, d in rejected.items()])
        return profile.coverage(**loaded).join(counts, "source")
    if mode != "full":
        raise ValueError(f"unknown mode: {mode}")

    raw_history = saved(stores.historical_rows(files.read_csv(spark, registry, _registry_text(), with_order=True)), "load-historical")
    raw_listings = saved(stores.listing_rows(files.read_listings(spark, listing_files, json_lines, with_order=True)), "load-listing")
    raw = {"historical": raw_history, "listing": raw_listings}
    history = save("historical", stores.upsert(current("historical", schemas.HISTORICAL), stores.valid_rows(raw_history), "id", files.ORDER))
    known = stores.upsert_listings(current("listing", schemas.LISTING), stores.valid_rows(raw_listings), files.ORDER)
    listings = save("listing", joins.fill_coordinates(known, "address", *gazetteers) if gazetteers else known)
    save("merged", standardise(history, listings, as_of, gazetteers))
    for name, rows in raw.items():
        save(f"rejected/{name}", stores.quarantined_rows(rows))
    return stacked(*[stores.load_summary(d).withColumn("source", F.lit(n)) for n, d in raw.items()])


def _registry_text():
    from pyspark.sql import types as T

    return T.StructType([T.StructField(c, T.StringType()) for c in schemas.REGISTRY_COLUMNS])


def post_process(merged: DataFrame, users: DataFrame, as_of: dt.date) -> DataFrame:
    """Processed features of the merged table: fill, engineer, affordability, encode, scale, project.

    The filled table is written once, since means, scaler and result each read it.
    """
    filled = saved(impute.handle_missing(merged), "filled")
    built = encode.affordability(encode.engineer(filled, as_of), users)
    return encode.processed_columns(encode.scale_calendar(encode.encode(built)))


def store_processed(merged: DataFrame, users: DataFrame, as_of: dt.date, root: str) -> str:
    """Replace the stored processed table."""
    return stores.refresh(encode.stored_types(post_process(merged, users, as_of)), root)


def train_and_evaluate(
    properties: DataFrame, users: DataFrame, folder: str, kind: str = "gbt", pairs_per_user: int = 10,
    sample_size: int | None = None, rounds: int = 40, numeric_preference: bool = False,
) -> dict[str, DataFrame | Model]:
    """Pairs, training, evaluation, importances, mistakes; model, scaler and what serving needs are saved.

    Beside the classifier asked for, a linear one is fitted on the same rows and
    kept as a table of weights with the medians that fill properties, which is
    what batch recommendations take. The split pairs are written below ``folder`` once, and so are the scored test
    rows; training and every report read them from there.
    """
    require_rows(properties=properties, users=users)
    spark = properties.sparkSession
    labelled = pairs.labelled_pairs(properties, users, pairs_per_user, sample_size, numeric_preference=numeric_preference)
    labelled.write.mode("overwrite").parquet(f"{folder}/pairs")
    split, scaler = pairs.scaled_split(spark.read.parquet(f"{folder}/pairs"))
    split.write.mode("overwrite").parquet(f"{folder}/split")
    ready = model.assembled(spark.read.parquet(f"{folder}/split"))
    train, test = ready.where(F.col("is_test") == 0), ready.where(F.col("is_test") == 1)
    fitted = model.train_classifier(train, kind, rounds=rounds)
    model.save_model(fitted, scaler, folder)
    linear = fitted if kind == "logistic" else model.train_classifier(train, "logistic", rounds=rounds)
    model.save_serving(model.stored_weights(linear), model.fill_values(properties), folder)
    inputs = [f"z_{c}" for c in schemas.MODEL_FEATURES]
    model.scored(fitted, test).select("pair_id", "y", "predicted", "probability", *inputs).write.mode("overwrite").parquet(f"{folder}/judged")
    judged = spark.read.parquet(f"{folder}/judged")
    return {
        "model": fitted,
        "scores": metrics.scores(judged),
        "confusion": metrics.confusion_matrix(judged),
        "report": metrics.classification_report(judged),
        "auc": metrics.roc_auc(judged),
        "history": model.training_history(fitted, train),
        "importances": metrics.top_importances(model.permutation_importance(fitted, test, inputs)),
        "mistakes": metrics.misclassification_report(judged, "pair_id", inputs),
    }


def recommend_saved(spark: SparkSession, folder: str, properties: DataFrame, profiles: DataFrame, k: int = 5, threshold: float = 0.5) -> DataFrame:
    """Recommendations of all profiles with the weights, scaler and fill values that training saved below ``folder``.

    Profiles hold plain texts; their tenure preference may be written with an
    underscore.
    """
    weights, fill = model.load_serving(spark, folder)
    return recommend_with(weights, spark.read.parquet(f"{folder}/scaler"), fill, properties, profiles, k, threshold)


def recommend_with(
    weights: model.StoredWeights, scaler: DataFrame, fill: DataFrame, properties: DataFrame, profiles: DataFrame, k: int = 5, threshold: float = 0.5,
) -> DataFrame:
    """Recommendations of all profiles by a linear model."""
    preference = text.preference_code(F.replace(F.col("tenure_preference"), F.lit("_"), F.lit(" ")))
    scored = model.serving_scores(weights, scaler, model.complete_properties(properties, fill), profiles.withColumn("tenure_preference", preference))
    return recommend.recommend(scored[1], scored[0], k, threshold)


def premerge(
    listings: DataFrame, registry: DataFrame, gazetteers: tuple[DataFrame, DataFrame] | None = None,
    new_date: dt.date = dt.date(2023, 12, 31),
) -> DataFrame:
    """Listings and registry rows stacked with one price, date and type column."""
    scraped = listings.withColumns({
        "price": text.price_number(F.col("price")),
        "normalized_address": text.with_shire(F.col("address")),
        "source": F.lit("scraped"),
    })
    parts = [F.col(c) for c in ("Street", "Locality", "`Town/City`", "District", "County")]
    recorded = registry.withColumns({
        "Price": text.price_number(F.col("Price").cast("string")),
        "normalized_address": text.joined_address(*parts),
        "source": F.lit("registry"),
    }).withColumnRenamed("Price", "registry_price")
    if gazetteers:
        empty = {c: F.lit(None).cast("double") for c in ("latitude", "longitude")}
        scraped, recorded = (
            joins.fill_coordinates(d.withColumns(empty), "normalized_address", *gazetteers) for d in (scraped, recorded))
    return premerge_columns(stacked(scraped, recorded), new_date)


def premerge_columns(df: DataFrame, new_date: dt.date) -> DataFrame:
    """Date by source, registry type code of scraped rows, and one price."""
    result = with_source_date(df, "Date of Transaction", new_date)
    own = F.col("`Property Type`") if "Property Type" in df.columns else F.lit(None).cast("string")
    result = result.withColumn("Property Type", F.when(F.col("property_type").isNotNull(), text.registry_code(F.col("property_type"))).otherwise(own))
    return result.withColumn("price", merged_price(F.col("price"), F.col("registry_price"))).drop("registry_price")


def merged_price(listed: Column, recorded: Column) -> Column:
    """Price of the listing, else of the registry."""
    return F.coalesce(listed, recorded)


def with_source_date(df: DataFrame, source_column: str, new_date: dt.date, result: str = "Date") -> DataFrame:
    """Date column: registry rows take the source column, scraped rows a fixed date.

    Without a source tag or a source column every row takes the fixed date.
    """
    fixed = F.lit(new_date)
    if "source" not in df.columns or source_column not in df.columns:
        return df.withColumn(result, fixed)
    recorded = F.to_date(dates.parsed_timestamp(F.col(f"`{source_column}`").cast("string")))
    return df.withColumn(result, F.when(F.col("source") == "registry", recorded).when(F.col("source") == "scraped", fixed))


def run_premerge(
    spark: SparkSession, listing_file: str, registry_file: str, target: str, gazetteers: tuple[DataFrame, DataFrame], json_lines: bool = False,
) -> DataFrame:
    """Write the pre-merged file, reusing a complete earlier one; with ``json_lines`` the listing file can be split."""
    if stores.file_complete(spark, target):
        return files.read_csv(spark, target)  # its date, type and price columns are final already
    listings = spark.read.schema(schemas.LISTING_RAW).option("multiLine", not json_lines).json(listing_file)
    registry = files.read_csv(spark, registry_file, _registry_text())
    stores.write_csv(premerge(listings, registry, gazetteers), target)
    return files.read_csv(spark, target)


def explore(df: DataFrame, key: str, n: int = 5) -> dict[str, DataFrame]:
    """Report on a table: types, first and last rows, description and unique values."""
    kinds = F.array(*[F.struct(F.lit(i).alias("place"), F.lit(c).alias("column"), F.lit(t).alias("type")) for i, (c, t) in enumerate(df.dtypes)])
    texts = [c for c, t in df.dtypes if t == "string"]
    return {
        "columns": df.agg(kinds.alias("kinds")).select(F.inline("kinds")),
        "head": df.orderBy(key).limit(n),
        "tail": df.orderBy(F.desc(key)).limit(n).orderBy(key),
        "description": profile.describe_all(df),
        "unique": profile.unique_values(df, texts),
    }
