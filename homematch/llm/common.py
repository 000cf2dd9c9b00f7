"""Small helpers that several text operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words are runs of anything but ASCII white space.
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the data folder."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def id_remainder(key: str, divisor: int) -> Column:
    """crc32 of a key as text, modulo ``divisor``; null keys count as an empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def ascii_lower(text: Column) -> Column:
    """Only A-Z lower-cased."""
    return F.translate(text, UPPER, LOWER)


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often and however deep ``use`` reads it."""
    return F.transform(F.array(value), use)[0]


def sampled(df: DataFrame, key: str, rows: int, total: int, seed: str) -> DataFrame:
    """About ``rows`` of ``total`` rows, chosen by a hash of the key, without an order over the table."""
    if total <= rows:
        return df
    share = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 30))
    return df.where(share < F.lit(int((1 << 30) * rows / total)))


def sql_words(text: str, pattern: str) -> str:
    """DuckDB list of the matches of a pattern in a text that may be null."""
    return f"regexp_extract_all(coalesce({text}, ''), '{pattern}')"


def quoted(text: str) -> str:
    """SQL text literal."""
    return "'" + re.sub("'", "''", text) + "'"
