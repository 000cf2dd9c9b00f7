"""Locality-sensitive digests of whole texts by bucket quartiles.

Six triplets of bytes from each window of five are hashed into 128 buckets. The
digest holds the length on a logarithmic scale, the ratios of the quartiles of
the bucket counts, and for every bucket the quartile its count falls into. Two
digests are compared by a difference of lengths, ratios and buckets, bounded by
the largest value it can have, and likeness is what is left of one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

BUCKETS = 128
#: Places of the three bytes in a window of five; each holds the first byte.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
RATIO_STEPS = 16
#: Difference of two buckets by how many quartiles apart they are.
APART = np.array([0, 1, 2, 6], np.int64)
LENGTH_WEIGHT, RATIO_WEIGHT, MOST_STEPS = 12, 12, 8
#: Likeness is zero at this difference and beyond.
BOUND = 400


def triplet_counts(data: np.ndarray) -> np.ndarray:
    """Bucket counts of all triplets of a byte array."""
    counts = np.zeros(BUCKETS, np.int64)
    if data.size < 5:
        data = np.concatenate([data, np.zeros(5 - data.size, np.uint8)])
    wide = data.astype(np.uint32)
    last = wide.size - 4
    for number, (i, j, k) in enumerate(TRIPLETS):
        word = wide[i : i + last] * np.uint32(0x9E3779B1)
        word += wide[j : j + last] * np.uint32(0x85EBCA77)
        word += wide[k : k + last] * np.uint32(0xC2B2AE3D)
        word += np.uint32((number + 1) * 0x27D4EB2F & 0xFFFFFFFF)
        word ^= word >> np.uint32(15)
        word *= np.uint32(0x2C1B3C6D)
        counts += np.bincount(word >> np.uint32(25), minlength=BUCKETS)
    return counts


def digest(data: bytes) -> str:
    """Fingerprint of a text's bytes, 34 bytes as hex: length, ratios, quartile codes."""
    counts = triplet_counts(np.frombuffer(data, np.uint8))
    order = np.sort(counts)
    q1, q2, q3 = (int(order[BUCKETS * n // 4 - 1]) for n in (1, 2, 3))
    length = min(255, round(math.log(len(data) + 1, 1.1)))
    ratios = [0 if q3 == 0 else min(RATIO_STEPS - 1, q * RATIO_STEPS // q3) for q in (q1, q2)]
    codes = (counts > q1).astype(np.uint8) + (counts > q2) + (counts > q3)
    packed = codes.reshape(-1, 4) << np.array([6, 4, 2, 0], np.uint8)
    return bytes([length, ratios[0] << 4 | ratios[1]]).hex() + packed.sum(axis=1, dtype=np.uint8).tobytes().hex()


def difference(left: str, right: str) -> int:
    """Weighted difference of two digests, before the bound."""
    a, b = np.frombuffer(bytes.fromhex(left), np.uint8), np.frombuffer(bytes.fromhex(right), np.uint8)
    apart = abs(int(a[0]) - int(b[0]))
    total = min(apart, MOST_STEPS) if apart <= 1 else LENGTH_WEIGHT * min(apart, MOST_STEPS)
    for shift in (4, 0):
        steps = abs((int(a[1]) >> shift & 15) - (int(b[1]) >> shift & 15))
        total += steps if steps <= 1 else RATIO_WEIGHT * min(steps - 1, MOST_STEPS)
    codes = [(x[2:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3).astype(np.int64) for x in (a, b)]
    return total + int(APART[np.abs(codes[0] - codes[1])].sum())


def likeness(left: str, right: str) -> float:
    """1 for equal digests, 0 from the bound on."""
    return 1.0 - min(difference(left, right), BOUND) / BOUND


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def range_edges(light: DataFrame, rows: int, most: int) -> list[int]:
    """Lowest orders of all ranges but the first, for ranges of about ``rows`` rows and at most ``most`` of them."""
    parts = min(most, -(-light.count() // rows))
    if parts <= 1:
        return []
    points = [i / parts for i in range(1, parts)]
    return sorted(set(light.agg(F.percentile_approx("order", points, 10 * parts).alias("p")).first()["p"]))


def with_following(docs: DataFrame, rows: int, most: int) -> DataFrame:
    """Rows of (doc_id, order, text), dealt by ranges of ``order`` and sorted; each range ends with guests.

    Guests are the first document of the next range, the first of all for the
    last range. Ranges that hold nothing are passed over. The driver sees a few
    numbers for each range, of which there are at most ``most``.
    """
    light = docs.select("order")
    edges = np.array(range_edges(light, rows, most), np.int64)

    @F.pandas_udf("int")
    def number(order: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(edges, order.to_numpy(), side="right"))

    held = light.select(number("order").alias("part"), "order").groupBy("part").agg(F.min("order").alias("first")).orderBy("part").collect()
    parts, firsts = np.array([r["part"] for r in held], np.int32), np.array([r["first"] for r in held], np.int64)

    @F.pandas_udf("array<int>")
    def places(order: pd.Series) -> pd.Series:
        """The own range, and for its first document the range before as well, as -1 - range."""
        values = order.to_numpy()
        at = np.searchsorted(firsts, values, side="right") - 1
        return pd.Series([[parts[i], -1 - parts[i - 1]] if v == firsts[i] else [parts[i]] for i, v in zip(at, values, strict=True)])

    placed = docs.select("doc_id", "order", "text", F.explode(places("order")).alias("place"))
    dealt = placed.select("doc_id", "order", "text", F.when(F.col("place") < 0, -1 - F.col("place")).otherwise(F.col("place")).alias("part"), (F.col("place") < 0).alias("guest"))
    return dealt.repartition("part").sortWithinPartitions("part", "guest", "order", "text")


def fingerprint_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", rows_per_range: int = 1024, most_ranges: int = 20_000,
) -> DataFrame:
    """Fingerprints of each text and of its edited text, with likenesses.

    The key must be a whole number. Null texts count as empty, and an empty text
    has a fingerprint too. Null keys come first in the order, equal keys are
    ordered by text; a single document follows itself; an empty table gives no
    rows; other columns, whatever their names, are ignored. Whole texts are
    shuffled once, and a task holds two documents at a time.
    """
    kept = docs.select(
        docs[key].alias("doc_id"),
        F.coalesce(docs[key].cast("bigint"), F.lit(-(1 << 63))).alias("order"),
        F.coalesce(docs[text].cast("string"), F.lit("")).alias("text"),
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                yield from zip(*(batch.column(n).slice(start, 256).to_pylist() for n in ("part", "guest", "doc_id", "text")), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in fields.split(", ")]
        out, held, last = [], 0, None
        for part, guest, name, content in rows(batches):
            if last is not None and last[0] == part:
                mark = digest(content.encode())
                changed = edited(last[2], content)
                changed_mark = digest(changed.encode())
                out.append((last[1], len(last[2]), changed, last[3], changed_mark, likeness(last[3], changed_mark), likeness(last[3], mark)))
                held += len(changed)
            elif not guest:
                mark = digest(content.encode())
            last = None if guest else (part, name, content, mark)
            if held > 8_000_000:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema)

    fields = f"doc_id {kept.schema['doc_id'].dataType.simpleString()}, n_chars bigint, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    schema = to_arrow_schema(fields)
    return with_following(kept, rows_per_range, most_ranges).mapInArrow(run, fields)


def to_arrow_schema(fields: str) -> pa.Schema:
    """Arrow schema of a field list of whole numbers, doubles and texts."""
    kinds = {"string": pa.string(), "double": pa.float64(), "int": pa.int32(), "smallint": pa.int16(), "tinyint": pa.int8()}
    return pa.schema([(name, kinds.get(kind, pa.int64())) for name, kind in (f.split() for f in fields.split(", "))])
