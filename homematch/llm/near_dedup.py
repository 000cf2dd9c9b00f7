"""Near duplicates by an inverted join over MinHash signature coordinates.

Every different shingle set has a signature of ``COORDINATES`` minima. A set is
posted under each (coordinate, value) pair; two sets are a candidate if they
agree in at least ``MATCHES`` coordinates. Postings follow prefix merging: with
all pairs in one global order, rarest first, two such sets must meet within
their first ``COORDINATES - MATCHES + 1`` pairs, so only those are posted and
the long lists of common values are skipped.

Links are only needed to join components, so each set is first compared with
the one set, central to lists, that it meets most often. What is then one
component is skipped, and only sets of different components that share a list
are looked at again: entries without a partner that can be similar leave their
list, and what stays is compared pair by pair. A list of thousands of copies
thus costs one comparison a copy. Whether two sets can be similar is told inside
the join by their sizes, by the low bits of their signatures, which show in how
many coordinates they can agree, and by parities: each shingle flips one of 512
bits, so the bits in which two sets differ are never more than the shingles in
which they do.

Candidates that are left are confirmed on full sets, worked out again from their
texts: in each round every set with the one candidate nearest to it by parities,
then, since that joins most families, all pairs that still are in different
components.

Two sets with similarity 0.8 agree in 51 of 64 coordinates on average and in
fewer than 32 with a probability of about 2e-8.

Rows that come out of an array, and files of ids that repeat, are judged far too
small by Spark, which would broadcast them; their joins are merge joins at every
size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from homematch.llm.components import components, extended
from homematch.llm.sharding import mixed
from homematch.session import saved

COORDINATES, MATCHES = 64, 32
#: Similarity of linked documents in per cent.
PERCENT = 80
#: Bits kept of each coordinate to count agreements; chance agreements, one in 16, only add pairs to look at.
SLICES = 4
#: Bits of the parities over full sets, a power of two; more of them skip more pairs of large sets that are no links.
PARITY_BITS = 512
SLICE_NAMES = [f"s{i}" for i in range(SLICES)]
PARITY_NAMES = [f"p{i}" for i in range(PARITY_BITS // 64)]
MARKS = [*SLICE_NAMES, *PARITY_NAMES]
#: Rounds in which each set is confirmed with its nearest candidate alone before all that are left are.
NEAREST_ROUNDS = 2
#: Lists in which a set meets a centre to be compared with it ahead; what meets less often is left to the exact step.
STAR_MEETINGS = 8
#: Most bits of the filter that tells which texts are read again (32 MB); up to there it has 8 bits for each id, beyond it lets more others through.
MOST_ID_BITS = 28
#: Shingles hashed for all coordinates at a time.
BLOCK = 2048
CACHE_WORDS = 100_000

_words: dict[bytes, int] = {}


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a text; a shorter text is one shingle, none without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    known = _words
    if len(known) > CACHE_WORDS:
        known.clear()
    hashes = []
    for w in words:
        h = known.get(w)
        if h is None:
            h = known[w] = xxhash.xxh3_64_intdigest(w)
        hashes.append(h)
    h = np.array(hashes, np.uint64)
    width = min(width, len(h))
    total = h[: len(h) - width + 1].copy()
    for i in range(1, width):
        total = mixed(total) * np.uint64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i]
    return np.unique(mixed(total))


def coefficients(count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(seed)
    return r.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1), r.integers(0, 1 << 63, count, dtype=np.uint64)


def signature(shingles: np.ndarray, factors: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Smallest 32-bit hash of a set in each coordinate."""
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), BLOCK):
        block = shingles[start : start + BLOCK]
        np.minimum(least, (factors[:, None] * block[None] + shifts[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def arrays(values: list[np.ndarray], kind) -> pa.ListArray:
    """Arrow list column of numpy arrays."""
    offsets = np.cumsum([0, *map(len, values)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(values) if values else np.empty(0, kind)))


def slices(signatures: np.ndarray) -> np.ndarray:
    """Low bits of all coordinates, one 64-bit number for each bit; shape (sets, SLICES)."""
    bits = (signatures.view(np.uint32)[:, None, :] >> np.arange(SLICES, dtype=np.uint32)[None, :, None]) & np.uint32(1)
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").view("<i8")[:, :, 0]


def parities(shingles: np.ndarray) -> np.ndarray:
    """Parity of the number of shingles that fall on each of the parity bits, as 64-bit numbers."""
    counts = np.bincount((shingles >> np.uint64(32)).astype(np.int64) % PARITY_BITS, minlength=PARITY_BITS)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8")


def signed_documents(docs: DataFrame, width: int, seed: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, signature, slices, parities) of every text; the key is a 128-bit digest of the full set."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "n_shingles", "set_key", "signature", *MARKS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, shifts = coefficients(COORDINATES, seed)
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                sets = [shingle_set(t, width) for t in batch.column(1).slice(start, 500).to_pylist()]
                signed = [signature(s, factors, shifts) if len(s) else np.empty(0, np.int32) for s in sets]
                full = np.array([len(s) > 0 for s in sets])
                marks = np.zeros((len(sets), len(MARKS)), np.int64)
                if full.any():
                    marks[full, :SLICES] = slices(np.stack([s for s in signed if len(s)]))
                    marks[full, SLICES:] = np.stack([parities(s) for s in sets if len(s)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(start, 500),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets], pa.binary()),
                    arrays(signed, np.int32),
                    *[pa.array(np.ascontiguousarray(marks[:, i])) for i in range(len(MARKS))],
                ], names)

    fields = ", ".join(f"{c} bigint" for c in MARKS)
    return docs.mapInArrow(run, f"doc_id {kind}, n_shingles bigint, set_key binary, signature array<int>, {fields}")


def id_filter(pairs: DataFrame, count: int) -> np.ndarray:
    """Bits in which the ids of ``count`` pairs are set, by a hash; other ids may be set as well. Its size follows the count."""
    size = 1 << min(max(16 * count - 1, 1 << 16).bit_length(), MOST_ID_BITS)
    at = F.pmod(F.xxhash64("rep"), F.lit(size))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(at, F.lit(64)).cast("int"))
    reps = pairs.select(F.explode(F.array("a", "b")).alias("rep"))
    held = reps.select(F.floor(at / 64).cast("bigint").alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    words = np.zeros(size // 64, np.int64)
    words[held["w"].to_numpy()] = held["b"].to_numpy()
    return words


def passing(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether ids with these 64-bit hashes pass a filter."""
    at = hashes % (64 * len(words))
    return (words[at >> 6] >> (at & 63) & 1).astype(bool)


def chosen(texts: DataFrame, pairs: DataFrame, count: int) -> DataFrame:
    """(rep, text) of the documents in ``count`` pairs, by one more scan; a few other documents may be given too.

    The ids to take are told by a filter, so other texts are not shuffled. Rows
    that repeat within a task are given once.
    """
    kind = texts.schema["doc_id"].dataType.simpleString()
    shared = texts.sparkSession.sparkContext.broadcast(id_filter(pairs, count))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            passes = passing(shared.value, batch.column(1).to_numpy(zero_copy_only=False)) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000).take(pa.array(np.flatnonzero(passes[start : start + 1000])))
                fresh = []
                for i, (name, text) in enumerate(zip(part.column(0).to_pylist(), part.column(2).to_pylist(), strict=True)):
                    mark = xxhash.xxh3_128_digest(f"{name} {text}".encode("utf-8", "replace"))
                    if mark not in seen:
                        seen.add(mark)
                        fresh.append(i)
                part = part.take(pa.array(fresh, pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2)], ["rep", "text"])

    return texts.select("doc_id", F.xxhash64("doc_id").alias("hash"), "text").mapInArrow(run, f"rep {kind}, text string")


def sizes_allow(a: Column, b: Column) -> Column:
    """Whether sets of these sizes can be similar enough."""
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def agree(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether two signatures can agree in enough coordinates, by their slices."""
    apart = a["s0"].bitwiseXOR(b["s0"])
    for name in SLICE_NAMES[1:]:
        apart = apart.bitwiseOR(a[name].bitwiseXOR(b[name]))
    return F.bit_count(apart) <= COORDINATES - MATCHES


def parities_apart(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Bits in which the parities of two sets differ."""
    return sum(F.bit_count(a[name].bitwiseXOR(b[name])) for name in PARITY_NAMES)


def parities_allow(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether two sets can be similar enough by the bits in which their parities differ."""
    return (100 + PERCENT) * parities_apart(a, b) <= (100 - PERCENT) * (a["n"] + b["n"])


def can_link(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Whether nothing that is known of two sets rules a link out."""
    return sizes_allow(a["n"], b["n"]) & agree(a, b) & parities_allow(a, b)


def prefixes(sets: DataFrame) -> DataFrame:
    """(rep, central, tokens) with the prefix of each set under the order of rarity.

    Values that one set alone holds come first in the order and are posted
    nowhere; they only shorten the rest of the prefix. ``central`` says how many
    others share the set's values.
    """
    token = F.call_function("shiftleft", F.col("pos").cast("bigint"), F.lit(32)) + (F.col("value").cast("bigint") + F.lit(1 << 31))
    tokens = sets.select("rep", F.posexplode("signature").alias("pos", "value")).select("rep", token.alias("token"))
    shared = tokens.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    held = tokens.hint("merge").join(shared, "token").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("held"))
    room = F.size("held") - F.lit(MATCHES - 1)
    central = F.aggregate("held", F.lit(0).cast("bigint"), lambda total, x: total + x["df"])
    return held.where(room > 0).select("rep", central.alias("central"), F.slice("held", F.lit(1), room)["token"].alias("tokens"))


def listed(held: DataFrame) -> DataFrame:
    """(token, rep, centre) of every entry of a list that holds several sets; ``centre`` is the list's most central one."""
    posts = held.select(F.explode("tokens").alias("token"), "rep", "central")
    centres = posts.groupBy("token").agg(F.max_by("rep", "central").alias("centre"), F.count("*").alias("k")).where("k > 1")
    return posts.hint("merge").join(centres, "token").select("token", "rep", "centre")


def star_pairs(live: DataFrame) -> DataFrame:
    """Each set with the centre it meets in most lists, if those are enough to say anything."""
    met = live.where(F.col("rep") != F.col("centre")).select("rep", "centre").repartition("rep")
    often = met.groupBy("rep", "centre").agg(F.count("*").alias("k")).where(F.col("k") >= STAR_MEETINGS)
    return often.groupBy("rep").agg(F.max_by("centre", "k").alias("b")).select(F.col("rep").alias("a"), "b")


def sides(*names: str) -> tuple[dict[str, Column], dict[str, Column]]:
    """Columns of both sides of a pair, prefixed ``a_`` and ``b_``."""
    return tuple({n: F.col(f"{side}_{n}") for n in names} for side in "ab")


def side(rows: DataFrame, name: str, columns: list[str]) -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{name}_{c}") for c in columns])


def agreeing(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) that can be links."""
    columns = ["rep", "n", *MARKS]
    a, b = sides(*columns)
    both = pairs.join(side(sets, "a", columns), F.col("a") == a["rep"]).join(side(sets, "b", columns), F.col("b") == b["rep"])
    return both.where(can_link(a, b)).select("a", "b").distinct()


def similar(pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Pairs (a, b) whose full sets are similar.

    Texts are shuffled, which compress, and sets are worked out beside each
    other; the set of a second text that stays the same is kept. Without pairs no
    text is read.
    """
    count = pairs.count()
    if not count:
        return pairs
    found = chosen(texts, pairs, count).hint("merge")
    left = pairs.join(found.withColumnsRenamed({"rep": "a", "text": "ta"}), "a")
    both = left.join(found.withColumnsRenamed({"rep": "b", "text": "tb"}), "b").select("a", "b", "ta", "tb")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, held = None, None
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                kept = []
                for i, (x, y) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                    if y != last:
                        last, held = y, shingle_set(y, width)
                    own = shingle_set(x, width)
                    shared = len(np.intersect1d(own, held, assume_unique=True))
                    if shared and 100 * shared >= PERCENT * (len(own) + len(held) - shared):
                        kept.append(i)
                part = part.take(pa.array(kept, pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1)], ["a", "b"])

    kind = pairs.schema["a"].dataType.simpleString()
    return both.mapInArrow(run, f"a {kind}, b {kind}")


ENTRY = ["token", "rep", "part", "is_main", "n", *MARKS]


def mixed_lists(live: DataFrame, parts: DataFrame, sets: DataFrame) -> DataFrame:
    """Entries of lists that hold sets of several components.

    In each list the component with most entries ``is_main``; its entries need
    not be compared with each other.
    """
    named = live.select("token", "rep").join(parts.withColumnRenamed("node", "rep").hint("merge"), "rep", "left").withColumn("part", F.coalesce("component", "rep")).drop("component")
    counts = named.groupBy("token", "part").agg(F.count("*").alias("k"))
    main = counts.groupBy("token").agg(F.max_by("part", "k").alias("main"), F.count("*").alias("parts")).where("parts > 1")
    mixed = saved(named.join(main, "token").select("token", "rep", "part", (F.col("part") == F.col("main")).alias("is_main")), "mixed-lists")
    return mixed.hint("merge").join(sets.select("rep", "n", *MARKS), "rep").select(*ENTRY)


def with_partners(entries: DataFrame) -> DataFrame:
    """Entries that can be linked with an entry of another component in their list."""
    a, b = sides(*ENTRY)
    meet = (a["token"] == b["token"]) & (a["part"] != b["part"]) & can_link(a, b)
    main, few, every = entries.where("is_main"), entries.where("NOT is_main"), entries
    kept = [side(x, "a", ENTRY).join(side(y, "b", ENTRY), meet, "left_semi") for x, y in ((main, few), (few, every))]
    return kept[0].unionByName(kept[1]).select(*[F.col(f"a_{c}").alias(c) for c in ENTRY])


def crossing_pairs(entries: DataFrame, held: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets of different components that share a list and can be links, with how far ``apart`` their parities are.

    A pair is met in the first list it shares.
    """
    columns = [*ENTRY, "tokens"]
    known = entries.hint("merge").join(held.select("rep", "tokens"), "rep")
    a, b = sides(*columns)
    differ = (a["part"] != b["part"]) & (b["is_main"] | (a["rep"] < b["rep"]))
    first = F.get(F.array_intersect(a["tokens"], b["tokens"]), 0) == a["token"]
    met = side(known.where("NOT is_main"), "a", columns).join(side(known, "b", columns), (a["token"] == b["token"]) & differ & can_link(a, b) & first)
    return met.select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b"), parities_apart(a, b).alias("apart")).distinct()


def nearest(pairs: DataFrame) -> DataFrame:
    """Of each set, on either side of its pairs, the pair with its nearest candidate."""
    of_a = pairs.groupBy("a").agg(F.min_by("b", "apart").alias("b"))
    of_b = pairs.groupBy("b").agg(F.min_by("a", "apart").alias("a"))
    return of_a.select("a", "b").unionByName(of_b.select("a", "b")).distinct()


def still_apart(pairs: DataFrame, parts: DataFrame) -> DataFrame:
    """Pairs whose sets are in different components of the links found so far."""
    left = pairs.join(parts.select(F.col("node").alias("a"), F.col("component").alias("ca")).hint("merge"), "a", "left")
    both = left.join(parts.select(F.col("node").alias("b"), F.col("component").alias("cb")).hint("merge"), "b", "left")
    return both.where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b", "apart")


def linked_by(parts: DataFrame, pairs: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Components after the links among the pairs; as they were if there are none."""
    links = saved(similar(pairs, texts, width), "pair-links")
    return parts if links.isEmpty() else saved(extended(parts, links), "parts")


def confirmed(pairs: DataFrame, parts: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Components of all links found before and those among the pairs that join components."""
    for _ in range(NEAREST_ROUNDS):
        if pairs.isEmpty():
            return parts
        first = saved(nearest(pairs), "nearest")
        parts = linked_by(parts, first, texts, width)
        pairs = saved(still_apart(pairs.join(first.hint("merge"), ["a", "b"], "left_anti"), parts), "pairs-left")
    return linked_by(parts, pairs.select("a", "b"), texts, width)


def own_links(linked: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) of documents with several different texts to the representatives of each."""
    key = F.xxhash64("set_key")
    several = linked.groupBy("doc_id").agg(F.min(key).alias("low"), F.max(key).alias("high")).where("low <> high").select("doc_id")
    held = linked.select("doc_id", "set_key").join(several, "doc_id").join(sets.select("set_key", "rep"), "set_key")
    return held.where(F.col("doc_id") != F.col("rep")).select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def near_duplicates(docs: DataFrame, width: int = 5, seed: int = 1, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document.

    Words are runs without ASCII white space, A-Z lower-cased. Null texts, empty
    ones and those without words have no shingles and no links. Equal sets are
    one class with its smallest doc_id as representative, so copies and repeated
    rows cost nothing beyond their count; rows that share a doc_id count as one
    document, linked by any of its texts. A null doc_id has no component and is
    not kept. Texts of any length are taken whole, and sets are compared by
    64-bit shingles. An empty table gives no rows; other columns, whatever their
    names, are ignored.
    """
    texts = docs.select(docs[key].alias("doc_id"), docs[text].cast("string").alias("text"))
    rows = saved(signed_documents(texts, width, seed), "signatures")
    linked = rows.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    own = ["doc_id", "n_shingles", "signature", *MARKS]
    sets = saved(linked.groupBy("set_key").agg(F.min(F.struct(*own)).alias("m")).select("set_key", "m.*").withColumnsRenamed({"doc_id": "rep", "n_shingles": "n"}), "sets")
    held = saved(prefixes(sets), "prefixes")
    live = saved(listed(held), "lists")
    star = saved(agreeing(star_pairs(live), sets), "star-pairs")
    near = saved(similar(star, texts, width).unionByName(own_links(linked, sets)), "star-links")
    parts = saved(components(near), "star-parts")
    entries = saved(with_partners(mixed_lists(live, parts, sets)), "entries")
    crossing = saved(crossing_pairs(entries, held), "crossing-pairs")
    parts = confirmed(crossing, parts, texts, width)
    classes = sets.select("set_key", "rep").join(parts.withColumnRenamed("node", "rep").hint("merge"), "rep", "left").select("set_key", F.coalesce("component", "rep").alias("component_id"))
    placed = rows.select("doc_id", "n_shingles", "set_key").join(classes, "set_key", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return placed.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))
