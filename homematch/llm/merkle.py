"""Merkle manifest of a dataset: leaves, subroots per group, one root, and a proof for every row.

A node is the lower-case hex SHA-256 of its children's hex digests in a row.
Levels are built by a slot pivot: conditional aggregates over a run of siblings
put its children into one column per slot; joining the columns and hashing gives
the parent, leaving out the own slot gives the siblings for the proof.

Leaves are numbered within their group by a range-partitioned order, so a large
group is never ordered in one task. A stage then deals whole blocks of
``fanout ** LEVELS`` neighbours to tasks with one shuffle and climbs that many
levels inside them: every level's run is a prefix of the same sort order, so the
levels need neither another shuffle nor another sort. Blocks become the nodes of
the next stage, 1,024 times fewer. Nothing is gathered on the driver but the
size of the largest group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from homematch.session import saved

#: Levels that one stage climbs; a block holds ``fanout ** LEVELS`` nodes.
LEVELS = 10
STEP = "struct<before: binary, after: binary>"


def digest(content: Column) -> Column:
    """SHA-256 of bytes, as 32 bytes."""
    return F.unhex(F.sha2(content, 256))


def hexed(nodes: Column) -> Column:
    """Digests in a row as the lower-case hex text that is hashed."""
    return F.lower(F.hex(nodes)).cast("binary")


def field(value: Column) -> Column:
    """A value with its byte count in front, ``-`` for null, so that no two rows run together."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    """Leaf digest of a row's values in the given order."""
    return digest(F.concat(*map(field, values)).cast("binary"))


def folded(node: Column, path: Column) -> Column:
    """Root that follows from a leaf and its path of siblings, in 32 bytes."""
    return F.aggregate(path, node, lambda held, step: digest(hexed(F.concat(step["before"], held, step["after"]))))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level and left to right, as hex text."""
    all_of_them = F.aggregate(path, F.lit(b""), lambda held, step: F.concat(held, step["before"], step["after"]))
    return F.sha2(hexed(all_of_them), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``pos``, the place of each row within its ``group``, and ``n``, the group's size.

    Rows are dealt by ranges of (group, order); ties and repeated rows are spread
    by their place in the input, so a third of equal rows is no single range.
    Counts per range and group, one row each, give the offsets.
    """
    stored = saved(rows.withColumn("_row", F.monotonically_increasing_id()), "merkle-rows")
    keys = ["group", *order, "_row"]
    dealt = stored.repartitionByRange(*keys).sortWithinPartitions(*keys)
    kept = saved(dealt.drop("_row").withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id()), "merkle-order")
    counts = kept.groupBy("_part", "group").agg(F.min("_at").alias("_first"), F.count("*").alias("_k"))
    ranges = Window.partitionBy("group").orderBy("_part")
    offsets = counts.select(
        "_part", "group", "_first",
        (F.sum("_k").over(ranges.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_k")).alias("_offset"),
        F.sum("_k").over(Window.partitionBy("group")).alias("n"),
    )
    return kept.join(offsets, ["_part", "group"]).withColumn("pos", F.col("_at") - F.col("_first") + F.col("_offset")).drop("_part", "_at", "_first", "_offset")


def climbed(nodes: DataFrame, fanout: int) -> DataFrame:
    """Adds ``block``, ``path`` inside the block and ``top``, the block's node, to rows of (group, pos, n, node)."""
    above = [*[f"_p{k}" for k in range(LEVELS)], "block"]
    held = nodes.withColumns({name: F.expr(f"pos div {fanout**k}") for k, name in enumerate(above)}).repartition("group", "block")
    held = held.withColumn("top", F.col("node")).withColumn("path", F.array().cast(f"array<{STEP}>"))
    for k in range(LEVELS):
        run = Window.partitionBy("group", *above[:k:-1])
        slot = F.col(above[k]) - F.col(above[k + 1]) * fanout
        held = held.withColumns({f"_c{s}": F.max(F.when(slot == s, F.col("top"))).over(run) for s in range(fanout)})
        slots = [F.coalesce(f"_c{s}", F.lit(b"")) for s in range(fanout)]
        others = [F.when(slot == s, F.lit(b"")).otherwise(c) for s, c in enumerate(slots)]
        step = F.struct(
            F.concat(*[F.when(slot > s, c).otherwise(F.lit(b"")) for s, c in enumerate(others)]).alias("before"),
            F.concat(*[F.when(slot < s, c).otherwise(F.lit(b"")) for s, c in enumerate(others)]).alias("after"),
        )
        several = F.col("n") > F.lit(fanout**k)
        held = held.withColumns({
            "top": F.when(several, digest(hexed(F.concat(*slots)))).otherwise(F.col("top")),
            "path": F.when(several, F.concat("path", F.array(step))).otherwise(F.col("path")),
        }).drop(*[f"_c{s}" for s in range(fanout)])
    return held.drop(*above[:-1])


def with_paths(nodes: DataFrame, fanout: int, finish) -> DataFrame:
    """Rows of (group, pos, n, node) with ``path`` and the columns that ``finish`` gives.

    ``finish`` takes one row (group, node) for each group, once a single node is
    left of it, and gives (group, path, ...): what the path goes on with.
    """
    largest = nodes.agg(F.max("n")).first()[0] or 0
    if largest <= 1:
        return nodes.join(finish(nodes.select("group", "node")), "group")
    inside = climbed(nodes, fanout)
    span = fanout**LEVELS
    tops = inside.where(F.col("pos") == F.col("block") * span).select("group", F.col("block").alias("pos"), F.ceil(F.col("n") / F.lit(span)).cast("bigint").alias("n"), F.col("top").alias("node"))
    above = with_paths(saved(tops, "merkle-tops"), fanout, finish)
    rest = above.drop("n", "node").withColumnsRenamed({"pos": "block", "path": "_rest"})
    return inside.join(rest, ["group", "block"]).withColumn("path", F.concat("path", "_rest")).drop("_rest", "block", "top")


def manifest(leaves: DataFrame, fanout: int = 2, key: str = "doc_id", group: str = "lang", node: str = "leaf") -> DataFrame:
    """Every row of (key, group, leaf and more) with ``subroot``, ``root`` and ``path``.

    Leaves ascend by key within their group, null keys first, equal keys by
    leaf; each run of ``fanout`` neighbours becomes one node, a shorter last run
    too, until one is left. Groups ascend by their bytes, the null group first,
    and their subroots make the root in the same way. A single row is its own
    root with an empty path; repeated rows are leaves of their own; an empty
    table gives no rows. The key may be of any type that has an order, the group
    is taken as text, digests are 32 bytes. Other columns are handed on; names
    that start with an underscore, ``pos``, ``n``, ``node``, ``block``, ``top``,
    ``path``, ``group``, ``subroot`` and ``root`` are this function's own.
    """
    named = F.when(F.col(group).isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), F.col(group).cast("string")))
    extra = [c for c in leaves.columns if c not in (key, group, node)]
    rows = leaves.select(F.col(key).alias("_key"), F.col(group).alias("_group"), named.alias("group"), F.col(node).alias("node"), *extra)

    def roots(groups: DataFrame) -> DataFrame:
        ordered = numbered(groups.select(F.lit("").alias("group"), F.col("group").alias("_name"), "node"), ["_name"])
        paths = with_paths(ordered, fanout, lambda one: one.select("group", F.col("node").alias("root"), F.array().cast(f"array<{STEP}>").alias("path")))
        return paths.select(F.col("_name").alias("group"), F.col("node").alias("subroot"), "path", "root")

    whole = with_paths(numbered(rows, ["_key", "node"]), fanout, roots)
    return whole.select(F.col("_key").alias(key), F.col("_group").alias(group), F.col("node").alias(node), *extra, "pos", "n", "subroot", "root", "path")


def dataset_manifest(docs: DataFrame, fields: list[str], tampered: dict[str, Column] | None = None, fanout: int = 2, key: str = "doc_id", group: str = "lang") -> DataFrame:
    """Manifest of a table whose leaves are digests of ``fields``, and its check against changed rows.

    ``tampered`` names fields whose value now is another one; ``folded_root`` is
    the root that follows from the leaf of the values as they are now and from
    the siblings of the manifest, ``verified`` whether it is the manifest's
    root. Null and empty values differ in their leaves; texts of any length are
    hashed whole, in the scan; other columns, whatever their names, are ignored.
    """
    now = [(tampered or {}).get(f, F.col(f)) for f in fields]
    leaves = docs.select(F.col(key), F.col(group), leaf(*[F.col(f) for f in fields]).alias("leaf"), leaf(*now).alias("now"))
    held = manifest(leaves, fanout, key, group)
    root = folded(F.col("now"), F.col("path"))
    return held.withColumn("folded_root", root).withColumn("verified", F.col("folded_root") == F.col("root"))
