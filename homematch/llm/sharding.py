"""Reproducible shuffle into shards by a Feistel permutation with cycle walking.

Rows get global numbers that depend on their keys only, never on partitions. A
keyed Feistel network permutes the smallest power-of-four domain that holds all
numbers; results outside the table are sent through again (cycle walking), so
the permutation is one of exactly the table's rows. Place ``p`` means shard
``p mod shards`` and slot ``p div shards``: both can be computed from a row
number alone, shards differ by one row at most, and slots have no gaps.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

ROUNDS = 6
ROWS_PER_BUCKET = 65_536
#: Copies of one row that a task numbers at a time; more of them are dealt to other tasks.
COPIES = 65_536


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(numbers: np.ndarray, total: int, seed: int) -> np.ndarray:
    """Places of row numbers 0..total-1 under the keyed permutation of that range."""
    half = np.uint64(max(1, ((max(total, 2) - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = mixed(np.arange(1, ROUNDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
    out = np.asarray(numbers).astype(np.uint64)
    walking = np.arange(out.size)
    while walking.size:
        value = out[walking]
        left, right = value >> half, value & mask
        for key in keys:
            left, right = right, left ^ (mixed(right + key) & mask)
        value = (left << half) | right
        out[walking] = value
        walking = walking[value >= np.uint64(total)]
    return out.astype(np.int64)


def place(number: Column, total: int, seed: int = 0) -> Column:
    """Column form of ``permuted``."""

    @F.pandas_udf("bigint")
    def walk(numbers: pd.Series) -> pd.Series:
        return pd.Series(permuted(numbers.to_numpy(), total, seed))

    return walk(number)


def numbered(df: DataFrame, rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[DataFrame, int]:
    """All rows of a light frame with ``row_number`` from 0, and their count.

    Equal rows are counted before the shuffle and take neighbouring numbers, so
    a row that makes up a third of the table is one row while it is ordered; its
    copies are then written out by many tasks.
    Buckets come from a hash of the whole row and hold about
    ``rows_per_bucket`` different rows; only one bucket is ordered at a time.
    """
    columns = df.columns
    total = df.count()
    buckets = max(1, -(-total // rows_per_bucket))
    bucket = F.pmod(F.xxhash64(*columns), F.lit(buckets)).alias("_bucket")
    counted = df.groupBy(*columns).agg(F.count("*").alias("_n")).select(*columns, "_n", bucket)
    inside = Window.partitionBy("_bucket").orderBy(*[F.col(c).asc_nulls_first() for c in columns])
    before = F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    sizes = df.groupBy(bucket).agg(F.count("*").alias("_held"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    offsets = sizes.select("_bucket", (F.sum("_held").over(earlier) - F.col("_held")).alias("_offset"))
    placed = counted.withColumn("_before", before).join(offsets, "_bucket")
    first = (F.col("_offset") + F.col("_before")).alias("_first")
    runs = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("_n") - 1) / COPIES)))
    spread = placed.select(*columns, "_n", first).withColumn("_run", runs)
    spread = spread.where(F.col("_n") <= COPIES).unionByName(spread.where(F.col("_n") > COPIES).repartition("_first", "_run"))
    start = F.col("_first") + F.col("_run") * COPIES
    stop = F.least(F.col("_first") + F.col("_n"), start + COPIES) - 1
    return spread.select(*columns, F.explode(F.sequence(start, stop)).alias("row_number")), total


def shard_rows(docs: DataFrame, shards: int, seed: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Shard and slot of every row.

    Null texts have size 8 and the crc of an empty text; equal rows are
    interchangeable and take different slots; null keys are ordered first; an
    empty table gives no rows; other columns, whatever their names, are ignored.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    light = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(content).cast("bigint") + 8).alias("size"),
        F.crc32(content.cast("binary")).alias("text_crc32"),
    )
    rows, total = numbered(light)
    at = rows.withColumn("_place", place(F.col("row_number"), total, seed))
    return at.select(
        "doc_id", "size", "text_crc32", "row_number",
        F.pmod("_place", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"_place div {shards}").alias("slot"),
    )
