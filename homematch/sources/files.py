"""Readers of registry files, listing files and stored tables.

Delimited files may hold line breaks inside quotes and are read by byte ranges
all the same: quotes are counted for each range, the counts before a range say
whether it starts inside quotes, and every range then puts its own records
together. Only the pieces of a record that crosses a border meet elsewhere.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql import types as T

from homematch import schemas

NULL_TEXTS = ["null", "NaN", ""]
#: Column that follows the order of files and of records in them.
ORDER = "_order"
WHOLE, HEAD, TAIL, MIDDLE = range(4)


def text_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files with the file and the byte range they were read in."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def byte_ranges(lines: DataFrame) -> DataFrame:
    """One row for each byte range: its number in the order of files and places, and whether quotes are open at its ends.

    There are as many rows as splits that the driver plans, so they can be
    broadcast.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    held = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    number = F.row_number().over(Window.orderBy("file", "start")) - 1
    known = held.select("file", "start", "odd", opened.alias("opened"), number.cast("bigint").alias("range"))
    return known.select("file", "start", "range", (F.col("opened") == 1).alias("opened"), ((F.col("opened") + F.col("odd")) % 2 == 1).alias("left_open"))


def assembled(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """(range, line, first, kind, value) of the records and pieces of records in each range.

    ``line`` is the number of a record's first line within its range, ``first``
    marks the first record of a file.
    """
    placed = lines.join(F.broadcast(ranges), ["file", "start"]).select("range", "opened", (F.col("start") == 0).alias("first"), "value")
    names = ["range", "line", "first", "kind", "value"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, inside, head, line, begun, starts_file, held = None, 0, False, 0, 0, False, []

        def frame(numbers: list | np.ndarray, kinds: int, values: list | pa.Array) -> pa.RecordBatch:
            whole = values if isinstance(values, pa.Array) else pa.array(values, pa.string())
            size, numbers = len(whole), np.asarray(numbers, np.int64)
            return pa.RecordBatch.from_arrays([
                pa.array(np.full(size, place)), pa.array(numbers), pa.array((numbers == 0) & starts_file), pa.array(np.full(size, kinds, np.int32)), whole], names)

        for batch in batches:
            numbers = batch.column(0).to_numpy()
            borders = np.flatnonzero(np.r_[True, numbers[1:] != numbers[:-1], True]) if len(numbers) else []
            for a, b in zip(borders[:-1], borders[1:], strict=True):
                if place != numbers[a]:
                    if held:
                        yield frame([begun], MIDDLE if head else TAIL, ["\n".join(held)])
                    place, inside, line, held = int(numbers[a]), int(batch.column(1)[a].as_py()), 0, []
                    head, begun, starts_file = bool(inside), 0, batch.column(2)[a].as_py()
                values = batch.column(3).slice(a, b - a)
                odd = pc.count_substring(values, '"').to_numpy() & 1
                after = (inside + np.cumsum(odd)) & 1
                before = after ^ odd
                single = (before == 0) & (after == 0)
                if single.any():
                    at = np.flatnonzero(single)
                    yield frame(at + line, WHOLE, values if len(at) == b - a else values.take(pa.array(at)))
                for i in np.flatnonzero(~single).tolist():
                    if not before[i]:
                        begun = line + i
                    held.append(values[i].as_py())
                    if not after[i]:
                        yield frame([begun], HEAD if head else WHOLE, ["\n".join(held)])
                        head, held = False, []
                inside, line = int(after[-1]), line + b - a
        if held:
            yield frame([begun], MIDDLE if head else TAIL, ["\n".join(held)])

    return placed.mapInArrow(run, "range bigint, line bigint, first boolean, kind int, value string")


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, first, _order) of every record of delimited files, line breaks inside quotes included.

    Quotes are taken to stand around fields and, doubled, inside them. A quote
    that is never closed takes all of its file that follows.
    """
    lines = text_lines(spark, path)
    ranges = byte_ranges(lines)
    whole = assembled(lines, ranges).where(F.col("kind") == WHOLE).drop("kind")
    crossed = ranges.where("opened OR left_open")
    pieces = assembled(lines, crossed).where(F.col("kind") != WHOLE).join(F.broadcast(ranges.select("range", "file")), "range")
    begins = (F.col("kind") == TAIL).cast("int")
    chain = F.sum(begins).over(Window.partitionBy("file").orderBy("range", begins).rowsBetween(Window.unboundedPreceding, 0))
    piece = F.struct("range", "line", "first", "value")
    joined = pieces.select("file", chain.alias("chain"), piece.alias("piece")).groupBy("file", "chain").agg(F.array_sort(F.collect_list("piece")).alias("pieces"))
    begun = F.col("pieces")[0]
    crossing = joined.select(begun["range"].alias("range"), begun["line"].alias("line"), begun["first"].alias("first"), F.array_join(F.col("pieces")["value"], "\n").alias("value"))
    order = F.call_function("shiftleft", F.col("range"), F.lit(36)) + F.col("line")
    value = F.when(F.col("value").endswith("\r"), F.expr("left(value, length(value) - 1)")).otherwise(F.col("value"))
    return whole.unionByName(crossing).select(value.alias("value"), "first", order.alias(ORDER)).where(F.trim("value") != "")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _parsed(records: DataFrame, schema: T.StructType, header: bool, with_order: bool) -> DataFrame:
    rows = records.where(~F.col("first")) if header else records
    fields = F.from_csv("value", _ddl(schema), {"quote": '"', "escape": '"'})
    return rows.select(fields.alias("_fields"), ORDER).select("_fields.*", *([ORDER] if with_order else []))


def read_registry(spark: SparkSession, path: str, with_order: bool = False) -> DataFrame:
    """Registry file without a header line."""
    return _parsed(csv_records(spark, path), schemas.REGISTRY_RAW, False, with_order)


def read_csv(spark: SparkSession, path: str | list[str], schema: T.StructType | None = None, with_order: bool = False) -> DataFrame:
    """Delimited files with a header line; types are inferred only without a schema.

    With ``with_order`` rows have a number ``_order`` that follows the order of
    files and of rows in them, however the files are split.
    """
    records = csv_records(spark, path)
    return _parsed(records, schema or inferred_schema(records), True, with_order)


#: Types that are tried in this order, with the texts they may have.
_KINDS = {
    "int": r"[+-]?\d+", "bigint": r"[+-]?\d+", "double": r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|NaN",
    "date": r"\d{4}-\d{2}-\d{2}", "timestamp": r"\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}(:\d{2})?.*", "boolean": r"(?i)true|false",
}


def inferred_schema(records: DataFrame) -> T.StructType:
    """Column names of the first record and the narrowest type that all values of a column fit; one pass over the records."""
    top = records.where("first").agg(F.min("value").alias("value")).first()["value"]
    if top is None:
        return T.StructType([])
    width = len(records.sparkSession.range(1).select(F.schema_of_csv(F.lit(top))).first()[0].split(":")) - 1
    texts = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(width)])
    names = _parsed(records.where("first").limit(1), texts, False, False).first()
    rows = _parsed(records, texts, True, False)
    fits = [F.bool_and(F.col(c).isNull() | (F.col(c).rlike(f"^({pattern})$") & F.col(c).try_cast(kind).isNotNull())) for c in texts.names for kind, pattern in _KINDS.items()]
    found = list(rows.agg(*fits).first())
    named = []
    for i, name in enumerate(names):
        kinds = [k for k, fit in zip(_KINDS, found[i * len(_KINDS):], strict=False) if fit]
        named.append(f"`{name or f'_c{i}'}` {kinds[0] if kinds else 'string'}")
    return T.StructType.fromDDL(", ".join(named))


def with_null_texts(df: DataFrame, texts: Sequence[str] = tuple(NULL_TEXTS)) -> DataFrame:
    """Texts that stand for a missing value as null, in every text column."""
    replaced = {
        f.name: F.when(~F.col(f.name).isin(list(texts)), F.col(f.name))
        for f in df.schema.fields if isinstance(f.dataType, T.StringType)
    }
    return df.withColumns(replaced) if replaced else df


def read_csv_with_nulls(spark: SparkSession, path: str | list[str], columns: Sequence[str], with_order: bool = False) -> DataFrame:
    """Delimited file as text columns, with the usual missing-value texts as null."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return with_null_texts(read_csv(spark, path, schema, with_order))


def county_of_file(path: Column) -> Column:
    """County in a file or folder name such as ``property_data_oxfordshire_900000.json``."""
    return F.nullif(F.regexp_extract(path, r"(?:property_data_|county=)([a-z]+)", 1), F.lit(""))


def read_listings(spark: SparkSession, paths: str | list[str], lines: bool = False, with_order: bool = False) -> DataFrame:
    """All listing files in one read, each row tagged with the county of its file.

    Files hold one JSON array each, or with ``lines`` one object per line, which
    large files should, since only those can be split between tasks. The order
    is that of ``read_csv``.
    """
    if lines:
        held = text_lines(spark, paths)
        ranges = byte_ranges(held).select("file", "start", "range")
        numbered = held.withColumn("_at", F.monotonically_increasing_id()).where(F.trim("value") != "")
        parsed = F.from_json("value", _ddl(schemas.LISTING_RAW)).alias("_fields")
        if not with_order:
            return held.where(F.trim("value") != "").select(parsed, "file").select("_fields.*", county_of_file(F.col("file")).alias("county"))
        order = F.call_function("shiftleft", F.col("range"), F.lit(33)) + F.pmod(F.col("_at"), F.lit(1 << 33))
        rows = numbered.join(F.broadcast(ranges), ["file", "start"]).select(parsed, "file", order.alias(ORDER))
        return rows.select("_fields.*", county_of_file(F.col("file")).alias("county"), ORDER)
    raw = spark.read.schema(schemas.LISTING_RAW).option("multiLine", True).json(paths).select("*", F.input_file_name().alias("_file"))
    tagged = raw.withColumn("county", county_of_file(F.col("_file")))
    if not with_order:
        return tagged.drop("_file")
    places = spark.createDataFrame([(f, i) for i, f in enumerate(sorted(raw.inputFiles()))], "_file string, _place bigint")
    order = F.call_function("shiftleft", F.col("_place"), F.lit(33)) + F.pmod(F.col("_at"), F.lit(1 << 33))
    numbered = tagged.withColumn("_at", F.monotonically_increasing_id()).join(F.broadcast(places), "_file")
    return numbered.withColumn(ORDER, order).drop("_file", "_place", "_at")


def read_any(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Table in a CSV or JSON file, chosen by its extension."""
    if path.endswith(".csv"):
        return read_csv(spark, path)
    if path.endswith(".json"):
        return spark.read.option("multiLine", not lines).json(path)
    raise ValueError("Unsupported file format. Please use CSV or JSON.")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """Stored table."""
    return spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, key: str, lower: int, upper: int, parts: int) -> DataFrame:
    """Database table, read in parallel key ranges."""
    return spark.read.jdbc(url, table, column=key, lowerBound=lower, upperBound=upper, numPartitions=parts)
