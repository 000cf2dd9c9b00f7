"""Property-buyer pairs, their features, label and split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from homematch import schemas
from homematch.functions import numbers, text
from homematch.operators.encode import fit_scaler, scale
from homematch.operators.filters import columns_with_prefix, first_rows, with_missing_columns
from homematch.operators.impute import fill_features, fill_medians, fill_pair_size
from homematch.operators.joins import with_row
from homematch.operators.ranking import bucket_offsets, hash_order, hash_rank
from homematch.session import saved

ANY_TENURE = 2
#: Leading hex digits of a hash by which rows are counted to find where a share of them ends.
CUT_DIGITS = 3


def tenure_pools(properties: DataFrame, key: str = "id") -> DataFrame:
    """Property ids per pool: one pool for each known tenure and one for all."""
    tenure = F.col("tenure").cast("int")
    pools = F.array_compact(F.array(F.lit(ANY_TENURE), F.when(tenure.isin(0, 1), tenure)))
    return properties.select(F.col(key).alias("property_id"), F.explode(pools).alias("pool"))


def sample_pairs(
    properties: DataFrame, users: DataFrame, pairs_per_user: int = 10, seed: int = 42, numeric_preference: bool = False,
) -> DataFrame:
    """Ids of min(k, n) distinct properties per user out of the pool the user accepts.

    Properties get a rank in the hash order of their pool. A user takes the k
    ranks from a hashed start on, wrapping at the end, and an equi-join on
    (pool, rank) resolves them: no product of users and properties, and even
    join keys whatever the pool sizes are. That is a merge join: users are
    judged by their size before each becomes k requests, and would be broadcast.
    A pool without properties falls back to all of them.
    """
    sizes = properties.agg(
        F.count_if(F.col("tenure") == 0).alias("freehold"),
        F.count_if(F.col("tenure") == 1).alias("leasehold"),
        F.count(F.lit(1)).alias("everything"),
    )
    freehold, leasehold, everything = (F.col(f"_sizes.{c}") for c in sizes.columns)
    code = text.preference_number if numeric_preference else text.preference_code
    wanted = code(F.col("tenure_preference"))
    pool = (
        F.when((wanted == 0) & (freehold > 0), 0)
        .when((wanted == 1) & (leasehold > 0), 1)
        .otherwise(ANY_TENURE)
    )
    picked = with_row(users, sizes, "_sizes").select(F.col("id").alias("user_id"), pool.alias("pool"), "_sizes")
    size = F.when(F.col("pool") == 0, freehold).when(F.col("pool") == 1, leasehold).otherwise(everything)
    number = F.conv(F.substring(hash_order(F.col("user_id"), seed), 1, 15), 16, 10).cast("bigint")
    picked = picked.withColumn("_size", size).where(F.col("_size") > 0)
    picked = picked.select(
        "user_id", "pool", "_size", (number % F.col("_size")).alias("_start"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.least(F.lit(pairs_per_user), F.col("_size")) - 1)).alias("_step"),
    )
    picked = picked.select("user_id", "pool", ((F.col("_start") + F.col("_step")) % F.col("_size")).alias("rank"))
    ranked = hash_rank(tenure_pools(properties), "property_id", by=["pool"], seed=seed)
    return picked.join(ranked.select("pool", "rank", "property_id").hint("merge"), ["pool", "rank"]).select("user_id", "property_id")


def pair_rows(pairs: DataFrame, properties: DataFrame, users: DataFrame) -> DataFrame:
    """Pairs with all columns of both sides and both ids.

    Both sides grow with the pairs and are judged by their files, which are far
    smaller than their rows, so neither is broadcast.
    """
    left = properties.withColumnRenamed("id", "property_id")
    shared = [c for c in users.columns if c in left.columns]
    right = users.drop(*shared).withColumnRenamed("id", "user_id") if "id" not in shared else users.withColumnRenamed("id", "user_id")
    return pairs.join(left.hint("merge"), "property_id").join(right.hint("merge"), "user_id")


def prepare_features(pairs: DataFrame, numeric_preference: bool = False) -> DataFrame:
    """Complete model features of pairs.

    Absent features become 0, sizes are filled by class, numbers by median and
    flags by 0; then the ratios and logarithms of each pair are taken.
    """
    counties = columns_with_prefix(pairs)
    stored = [c for c in schemas.PROPERTY_FEATURES if c not in {*schemas.COUNTY_FLAGS, "log_price", "log_size"}]
    full = with_missing_columns(pairs, [*stored, *schemas.USER_FEATURES])
    code = text.preference_number if numeric_preference else text.preference_code
    full = full.withColumn("tenure_preference", code(F.col("tenure_preference")))
    ratios = {"price_to_income_ratio", "price_to_savings_ratio", "affordability_score"}
    flags = [*schemas.FLAGS, *counties]
    measured = [c for c in stored + schemas.USER_FEATURES if c not in {*flags, *ratios}]
    filled = fill_features(fill_pair_size(full), measured, flags)
    price = F.col("price")
    return filled.withColumns({
        **numbers.pair_ratios(price, F.col("income"), F.col("savings")),
        "log_price": F.log1p(price),
        "log_size": F.log1p("size_sq_ft"),
        "tenure": F.col("tenure").cast("int"),
        "tenure_preference": F.col("tenure_preference").cast("int"),
    })


def suitability_conditions() -> dict[str, Column]:
    """The five tests a suitable pair has to pass."""
    preference = F.col("tenure_preference")
    return {
        "affordability": F.col("affordability_score") >= 0.3,
        "bedrooms": F.col("bedrooms") >= F.col("family_size") * 0.3,
        "price_to_income": F.col("price_to_income_ratio") <= 7,
        "size": F.col("size_sq_ft") >= F.col("family_size") * 50,
        "tenure": (F.col("tenure") == preference) | (preference == ANY_TENURE),
    }


def suitable() -> Column:
    """Whether a pair passes all tests, as 0 or 1; a test on a missing value fails."""
    result = F.lit(True)
    for test in suitability_conditions().values():
        result = result & F.coalesce(test, F.lit(False))
    return result.cast("int")


def stratified_split(df: DataFrame, label: str, key: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Flag ``is_test`` on an exact share of each class, in the hash order of a key.

    The rows are not ranked: the last test row of each class is found from
    labels and keys alone, and a row is a test row if it does not come after it.
    Only where rows of that one key fall on both sides are they numbered.
    """
    cuts = saved(last_test_rows(df, label, key, test_share, seed), "cuts")
    whole = F.col(label).isNotNull() & F.col(key).isNotNull()
    known = df.where(whole).withColumn("_hash", hash_order(F.col(key), seed)).join(F.broadcast(cuts), label)
    tied = F.coalesce(F.struct("_hash", F.col(key).alias("key")) == F.col("_cut"), F.lit(False))
    before = F.coalesce(F.struct("_hash", F.col(key).alias("key")) < F.col("_cut"), F.lit(False))
    flagged = known.withColumn("is_test", (before | tied).cast("int"))
    if not cuts.where(F.col("_taken") < F.col("_tied")).isEmpty():
        place = F.row_number().over(Window.partitionBy(label).orderBy("_hash"))
        flagged = known.where(~tied).withColumn("is_test", before.cast("int")).unionByName(
            known.where(tied).withColumn("is_test", (place <= F.col("_taken")).cast("int")))
    return flagged.select(*df.columns, "is_test")


def last_test_rows(df: DataFrame, label: str, key: str, test_share: float, seed: int) -> DataFrame:
    """Per class the hash and key of its last test row as ``_cut``, null without one; of the
    ``_tied`` rows with that key, ``_taken`` are test rows.

    Rows are counted per leading digits of their hash; only those of the one
    bucket in which the share ends are sorted. Rows without a key count in the
    share and come first, but are no test rows.
    """
    keys = df.where(F.col(label).isNotNull()).select(F.col(label), F.col(key).alias("key")).withColumn("_hash", hash_order(F.col("key"), seed))
    keys = keys.withColumn("_bucket", F.substring("_hash", 1, CUT_DIGITS))
    spans = bucket_offsets(keys, [label], "_bucket", F.lit(1).cast("bigint")).withColumn("_share", F.round(F.col("_total") * test_share).cast("bigint"))
    ends = spans.where((F.col("_before") < F.col("_share")) & (F.col("_before") + F.col("_held") >= F.col("_share"))).select(label, "_bucket", "_share", "_before")
    equal = keys.join(F.broadcast(ends), [label, "_bucket"]).groupBy(label, "_hash", "key", "_share", "_before").agg(F.count(F.lit(1)).alias("_tied"))
    running = F.sum("_tied").over(Window.partitionBy(label).orderBy("_hash", "key").rowsBetween(Window.unboundedPreceding, 0))
    last = equal.withColumn("_taken", F.col("_share") - F.col("_before") - running + F.col("_tied")).where((F.col("_taken") > 0) & (F.col("_taken") <= F.col("_tied")))
    return spans.select(label).distinct().join(last.select(label, F.struct("_hash", "key").alias("_cut"), "_tied", "_taken"), label, "left")


def labelled_pairs(
    properties: DataFrame, users: DataFrame, pairs_per_user: int = 10, sample_size: int | None = None,
    seed: int = 42, numeric_preference: bool = False,
) -> DataFrame:
    """Sampled pairs with features, label ``y`` and key ``pair_id``.

    ``sample_size`` keeps the first rows of each input by id, a
    set-up for small experiments; by default everything is used. The sampled
    pairs are written once, since the filling steps read them several times.
    """
    properties, users = first_rows(properties, "id", sample_size), first_rows(users, "id", sample_size)
    pairs = sample_pairs(properties, users, pairs_per_user, seed, numeric_preference)
    rows = saved(pair_rows(pairs, properties, users), "pairs")
    ready = prepare_features(rows, numeric_preference)
    return ready.withColumns({
        "y": suitable(),
        "pair_id": F.concat_ws("-", F.col("user_id").cast("string"), F.col("property_id").cast("string")),
    })


def scaled_split(
    pairs: DataFrame, features: Sequence[str] = tuple(schemas.MODEL_FEATURES), key: str = "pair_id", seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """Split pairs and scale them with figures of the training part only.

    Returns the pairs with ``is_test`` and ``z_`` columns, and the scaler.
    """
    divided = stratified_split(pairs, "y", key, seed=seed)
    scaler = saved(fit_scaler(divided.where(F.col("is_test") == 0), features), "scaler")
    renamed = divided.withColumns({f"z_{c}": F.col(c).cast("double") for c in features})
    z_scaler = scaler.select(*[F.col(f"{c}_{part}").alias(f"z_{c}_{part}") for c in features for part in ("mean", "std")])
    return scale(renamed, z_scaler, [f"z_{c}" for c in features]), scaler
