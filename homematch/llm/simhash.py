"""Near duplicates by SimHash fingerprints and an exact tiled comparison.

A fingerprint has a bit set where over half of a text's shingle hashes have it.
Different fingerprints are dealt into tiles by their population count, a large
count into several tiles by a hash. Two fingerprints within the radius differ in
their population counts by the radius at most, so only pairs of such tiles are
made. Inside a pair the fingerprints stand in cells of equal population counts
of four quarters; cells whose counts differ by more than the radius in sum are
skipped, the rest are compared by numpy exclusive-or and bit counts. Nothing is
found by chance: every pair within the radius is compared.

A pair of tiles gives a spanning forest of its links, at most one link for each
fingerprint, so many near copies are never written as all their pairs.

Work grows with the square of the number of different fingerprints; the quarters
leave about 4 % of all pairs where fingerprints are spread evenly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from homematch.llm.components import components
from homematch.session import saved

BITS, RADIUS, SEED = 64, 3, 42
#: Fingerprints of a tile, about; a pair of tiles takes 16 bytes for each in a task.
TILE = 65_536
#: Shingles hashed at a time, and pairs of fingerprints compared at a time.
BLOCK, COMPARED = 65_536, 1 << 20
QUARTER = np.uint64(0xFFFF)


def hashes(text: str | None, width: int) -> Iterator[np.ndarray]:
    """64-bit hashes of the shingles of a text, repeats included, in blocks; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    width = min(width, len(words))
    stops = ends[width - 1 :].tolist() if words else []
    starts = [0, *(ends[: len(words) - width] + 1).tolist()]
    take = xxhash.xxh64_intdigest
    for at in range(0, len(stops), BLOCK):
        spans = zip(starts[at : at + BLOCK], stops[at : at + BLOCK], strict=False)
        yield np.array([take(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(text: str | None, width: int = 3) -> int:
    """Bits that over half of the hashes have; 0 for a text without words."""
    counts, total = np.zeros(BITS, np.int64), 0
    for block in hashes(text, width):
        bits = np.unpackbits(block.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
        total += len(block)
    return sum(1 << int(i) for i in np.flatnonzero(2 * counts > total))


def signed_documents(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, mark) of every text; ``mark`` holds the fingerprint's 64 bits as a whole number."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                texts = batch.column(1).slice(start, 500).to_pylist()
                marks = np.array([fingerprint(t, width) for t in texts], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, 500), pa.array(marks)], ["doc_id", "mark"])

    return docs.mapInArrow(run, f"doc_id {kind}, mark bigint")


def quarters(marks: np.ndarray) -> np.ndarray:
    """Population counts of the four quarters of each fingerprint."""
    return np.stack([np.bitwise_count((marks >> np.uint64(s)) & QUARTER) for s in (0, 16, 32, 48)], axis=1).astype(np.int16)


class Cells:
    """Fingerprints of a tile, sorted by their quarters' population counts."""

    def __init__(self, marks: np.ndarray):
        counts = quarters(marks)
        code = counts.astype(np.int64) @ np.array([17**3, 17**2, 17, 1])
        order = np.argsort(code, kind="stable")
        self.marks, at = marks[order], code[order]
        self.starts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]]) if len(at) else np.empty(0, np.int64)
        self.stops = np.r_[self.starts[1:], len(at)].astype(np.int64)
        self.counts = counts[order][self.starts]


def linked(left: Cells, right: Cells, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (in left, in right) of fingerprints within the radius, block by block."""
    sizes = right.stops - right.starts
    for cell in range(len(left.starts)):
        near = np.abs(right.counts - left.counts[cell]).sum(axis=1) <= radius
        if not near.any():
            continue
        places = np.flatnonzero(np.repeat(near, sizes))
        others = right.marks[places]
        step = max(1, COMPARED // len(others))
        for a in range(left.starts[cell], left.stops[cell], step):
            b = min(a + step, left.stops[cell])
            x, y = np.nonzero(np.bitwise_count(left.marks[a:b, None] ^ others[None]) <= radius)
            if len(x):
                yield x + a, places[y]


def merged(label: np.ndarray, x: np.ndarray, y: np.ndarray) -> None:
    """Joins places in ``label``, where every place points to the smallest of its part."""
    while True:
        a, b = label[x], label[y]
        apart = a != b
        if not apart.any():
            return
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))
        while (label != label[label]).any():
            label[:] = label[label]


def forest(left: np.ndarray, right: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is within the radius of each other in two tiles, or inside one; one for each fingerprint at most."""
    a = Cells(left)
    b = a if right is None else Cells(right)
    shift = 0 if right is None else len(left)
    marks = a.marks if right is None else np.concatenate([a.marks, b.marks])
    label = np.arange(len(marks))
    for x, y in linked(a, b, radius):
        merged(label, x, y + shift)
    moved = np.flatnonzero(label != np.arange(len(label)))
    return marks[label[moved]], marks[moved]


def tile_pairs(marks: DataFrame, radius: int, tile: int) -> DataFrame:
    """(left, right) fingerprints of every two tiles whose population counts are within the radius; ``right`` is null for a tile with itself.

    The driver sees the 65 counts of fingerprints by population count.
    """
    ones = F.expr("bit_count(mark)").cast("int")
    tiles = [1] * (BITS + 1)
    for row in marks.groupBy(ones.alias("p")).agg(F.count("*").alias("k")).collect():
        tiles[row["p"]] = -(-row["k"] // tile)
    number = F.array(*map(F.lit, tiles))
    held = marks.select("mark", ones.alias("p")).select("mark", "p", F.pmod(F.xxhash64("mark"), F.get(number, F.col("p"))).cast("int").alias("i"))
    held = saved(held.groupBy("p", "i").agg(F.collect_list("mark").alias("marks")), "simhash-tiles")

    def partners(first: Column, last: Column) -> Column:
        counts = F.sequence(F.greatest(first, F.lit(0)), F.least(last, F.lit(BITS)))
        return F.explode(F.flatten(F.transform(counts, lambda q: F.transform(F.sequence(F.lit(0), F.get(number, q) - 1), lambda j: F.struct(q.alias("p"), j.alias("i"))))))

    own, other = F.struct("p", "i"), F.col("other")
    left = held.select(own.alias("a"), partners(F.col("p"), F.col("p") + radius).alias("other"), "marks").where(F.col("a") <= other)
    right = held.select(own.alias("b"), partners(F.col("p") - radius, F.col("p")).alias("other"), "marks").where(other < F.col("b"))
    pairs = left.select(F.col("a"), F.col("other").alias("b"), F.col("marks").alias("left")).join(
        right.select(F.col("other").alias("a"), "b", F.col("marks").alias("right")), ["a", "b"], "left")
    return pairs.where(F.col("right").isNotNull() | (F.col("a") == F.col("b"))).select("left", "right")


def links(marks: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """(a, b) of different fingerprints, enough of them to join all that are within the radius of each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                sides = [None if not c[row].is_valid else c[row].values.to_numpy(zero_copy_only=False).view(np.uint64) for c in batch.columns]
                a, b = forest(*sides, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return tile_pairs(marks, radius, tile).mapInArrow(run, "a bigint, b bigint")


def simhash_duplicates(docs: DataFrame, width: int = 3, radius: int = RADIUS, tile: int = TILE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document.

    Words are runs without ASCII white space, A-Z lower-cased; shingles are
    ``width`` words with their repeats, the whole sequence of a shorter text.
    Null and empty texts and those without words have fingerprint zero and are
    linked like any other. Equal fingerprints are one node with its smallest
    doc_id, so copies and repeated rows cost nothing beyond their count, and a
    bit that just half of the hashes have is not set. Texts of any length are
    hashed whole, in blocks. A row without doc_id has a fingerprint but no
    component, and joins nothing. An empty table gives no rows; other columns,
    whatever their names, are ignored.
    """
    texts = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"))
    signed = saved(signed_documents(texts, width), "simhash-marks")
    nodes = saved(signed.where("doc_id IS NOT NULL").groupBy("mark").agg(F.min("doc_id").alias("rep")), "simhash-nodes")
    parts = saved(components(saved(links(nodes.select("mark"), radius, tile), "simhash-links")), "simhash-parts")
    placed = nodes.join(parts.withColumnRenamed("node", "mark"), "mark", "left").withColumn("part", F.coalesce("component", "mark"))
    least = placed.groupBy("part").agg(F.min("rep").alias("component_id"))
    classes = placed.select("mark", "part").join(least, "part").select("mark", "component_id")
    found = signed.join(classes, "mark", "left")
    shown = F.lpad(F.lower(F.hex("mark")), 16, "0")
    return found.select("doc_id", shown.alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
