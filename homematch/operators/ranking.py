"""Order-based operators that never put a whole group into one task.

Ranks and running sums are taken in two levels: rows fall into many ordered
buckets, the small per-bucket totals give each bucket its offset, and only the
rows of one bucket are sorted together. A group holding most of the table is
therefore spread over all its buckets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Distinct values that are sorted in one task without being split.
SORTED_TOGETHER = 4096
#: Split points of larger groups, one less than a power of two.
SPLITS = 1023
#: Rows that one bucket of a hash order holds, about.
ROWS_PER_BUCKET = 32_768


def split_buckets(counts: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    """Adds ``bucket``, which grows with the value, to rows of distinct values.

    A sketch over each group's values gives points that split them into about
    equal parts, wherever they lie; a value's bucket is the number of points
    below it. The sketch only decides how even the buckets are: what is counted
    in them stays exact. Group keys must not be null.
    """
    points = [i / (SPLITS + 1) for i in range(1, SPLITS + 1)]
    sketch = counts.groupBy(*by).agg(F.percentile_approx(value, points, 10 * SPLITS).alias("_points"), F.count("*").alias("_k"))
    splits = sketch.select(*by, F.when(F.col("_k") > SORTED_TOGETHER, F.col("_points")).alias("_splits"))
    known = counts.join(splits, list(by)) if by else counts.withColumn("_splits", splits.scalar())
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(SPLITS.bit_length()))])

    def further(at: Column, step: Column) -> Column:
        return at + F.when(F.get("_splits", at + step - 1) < F.col(value), step).otherwise(F.lit(0))

    return known.withColumn("bucket", F.when(F.col("_splits").isNull(), 0).otherwise(F.aggregate(steps, F.lit(0), further))).drop("_splits")


def bucket_offsets(df: DataFrame, by: Sequence[str], bucket: str, amount: Column) -> DataFrame:
    """Per group and bucket: ``_held`` in it, ``_before`` it and ``_total``.

    The windows run over one row per bucket, not over data rows.
    """
    held = df.groupBy(*by, bucket).agg(F.sum(amount).alias("_held"))
    group = Window.partitionBy(*by)
    return held.select(
        *by,
        bucket,
        "_held",
        (F.sum("_held").over(group.orderBy(bucket).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_held")).alias("_before"),
        F.sum("_held").over(group).alias("_total"),
    )


def running_sum(
    df: DataFrame, by: Sequence[str], bucket: str, order: Sequence[str], amount: str,
    result: str = "running", total: str | None = None,
) -> DataFrame:
    """Inclusive running sum of ``amount`` in bucket then ``order``, per group.

    Group keys must not be null. ``bucket`` has to grow with ``order``.
    """
    offsets = bucket_offsets(df, by, bucket, F.col(amount))
    inside = Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    kept = [*df.columns, (F.col("_before") + F.sum(amount).over(inside)).alias(result)]
    if total:
        kept.append(F.col("_total").alias(total))
    return df.join(offsets, [*by, bucket]).select(*kept)


def hash_order(key: Column, seed: int) -> Column:
    """Text that puts rows into a fixed pseudo-random order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def hash_rank(
    df: DataFrame, key: str, by: Sequence[str] = (), seed: int = 0,
    rank: str = "rank", total: str = "total", rows_per_bucket: int = ROWS_PER_BUCKET,
) -> DataFrame:
    """Rank from 0 of each row in the hash order of a unique key, per group.

    The leading hex digits of the hash are the buckets, so they are even
    whatever the group sizes are; a count of the rows, taken in the same job,
    says how many digits that takes. Frames that are costly to work out should
    be saved first, since they are read for that count too. The result depends
    neither on partitioning nor on the size of buckets.
    """
    digits = F.ceil(F.log(16.0, F.greatest(F.count("*") / rows_per_bucket, F.lit(1.5)))).cast("int")
    tagged = df.withColumn("_hash", hash_order(F.col(key), seed))
    tagged = tagged.withColumn("_bucket", F.substring("_hash", F.lit(1), df.agg(digits.alias("digits")).scalar())).withColumn("_one", F.lit(1).cast("bigint"))
    ranked = running_sum(tagged, by, "_bucket", ["_hash", key], "_one", "_position", total)
    return ranked.withColumn(rank, F.col("_position") - 1).drop("_hash", "_bucket", "_one", "_position")


def long_values(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), kind: str = "double", weight: str | None = None,
) -> DataFrame:
    """One row per present value: group columns, ``column``, ``value`` and its weight ``n``."""
    entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast(kind).alias("value")) for c in columns])
    present = F.col("value").isNotNull()
    times = (F.col(weight) if weight else F.lit(1)).cast("bigint").alias("n")
    tall = df.select(*by, times, F.inline(entries))
    return tall.where(present & ~F.isnan("value") if kind == "double" else present)


def value_counts(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), kind: str = "string", weight: str | None = None,
) -> DataFrame:
    """Rows per distinct value of every named column, in one pass."""
    return long_values(df, columns, by, kind, weight).groupBy(*by, "column", "value").agg(F.sum("n").alias("n"))


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], points: Sequence[float], by: Sequence[str] = (), weight: str | None = None,
) -> DataFrame:
    """Exact interpolated quantiles: ``by``, ``column``, ``point`` and ``value``.

    Equal values are counted first; then only the buckets that hold a wanted
    rank are sorted. Rows with a null group key are left out. With ``weight`` a
    row stands for that many rows.
    """
    present = df
    for key in by:
        present = present.where(F.col(key).isNotNull())
    counts = value_counts(present, columns, by, "double", weight)
    counts = split_buckets(counts, [*by, "column"])
    keys = [*by, "column", "bucket"]
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in points]))
    spans = bucket_offsets(counts, [*by, "column"], "bucket", F.col("n")).withColumn("point", wanted)
    place = (F.col("_total") - 1) * F.col("point")
    spans = spans.withColumn("_low", F.floor(place) + 1).withColumn("_high", F.ceil(place) + 1)
    spans = spans.withColumn("_part", place - F.floor(place))
    spans = spans.where((F.col("_before") < F.col("_high")) & (F.col("_before") + F.col("_held") >= F.col("_low")))
    inside = Window.partitionBy(*keys, "point").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    running = counts.join(spans, keys).withColumn("_last", F.col("_before") + F.sum("n").over(inside))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_last") >= F.col(rank)) & (F.col("_last") - F.col("n") < F.col(rank)), F.col("value")))

    low, high = at("_low"), at("_high")
    return running.groupBy(*by, "column", "point").agg((low + (high - low) * F.max("_part")).alias("value"))


def exact_medians(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), weight: str | None = None) -> DataFrame:
    """Exact medians, one column each; without ``by`` always exactly one row."""
    tall = exact_quantiles(df, columns, [0.5], by, weight)
    picked = [F.max(F.when(F.col("column") == c, F.col("value"))).alias(c) for c in columns]
    return tall.groupBy(*by).agg(*picked) if by else tall.agg(*picked)


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value of each column, the smallest on ties; one row."""
    counts = value_counts(df, columns)
    best = counts.groupBy("column").agg(F.min(F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("top"))
    return best.agg(*[F.max(F.when(F.col("column") == c, F.col("top.value"))).alias(c) for c in columns])


def top_per_group(df: DataFrame, by: Sequence[str], order: Sequence[Column], k: int, position: str = "position") -> DataFrame:
    """First ``k`` rows of each group; tasks keep only ``k`` rows before the shuffle."""
    window = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(position, F.row_number().over(window)).where(F.col(position) <= k)


def first_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Row with the smallest ``order`` of each key; see ``_end_by_key``."""
    return _end_by_key(df, key, order, F.min(order))


def last_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """Row with the largest ``order`` of each key; see ``_end_by_key``."""
    return _end_by_key(df, key, order, F.max(order))


def _end_by_key(df: DataFrame, key: str, order: str, end: Column) -> DataFrame:
    """Rows whose ``order`` is the end of their key's; null keys are one key.

    ``order`` is a present number or date that no two rows of a key share. Only
    keys and orders are aggregated, by hash and before the shuffle; whole rows
    are fetched by key and order together, so the rows of a hot key are spread.
    """
    ends = df.groupBy(F.col(key).alias("_end_key")).agg(end.alias("_end"))
    return df.join(ends, F.col(key).eqNullSafe(F.col("_end_key")) & (F.col(order) == F.col("_end")), "left_semi")
