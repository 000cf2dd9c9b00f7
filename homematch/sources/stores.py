"""Writers: files, table generations, upserts, quarantine and typed loads."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from homematch import schemas
from homematch.functions import dates, text
from homematch.functions.arrays import parsed_list
from homematch.operators.joins import one_row
from homematch.operators.ranking import hash_rank, last_by_key
from homematch.session import saved
from homematch.sources.files import ORDER, read_csv


def write_csv(df: DataFrame, path: str) -> None:
    """Delimited files with a header line; list columns are written as JSON text."""
    lists = {f.name: F.to_json(f.name) for f in df.schema.fields if f.dataType.typeName() in ("array", "struct")}
    flat = df.withColumns(lists) if lists else df
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def _files(spark: SparkSession, root: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def generations(spark: SparkSession, root: str) -> list[str]:
    """Complete generations of a table, oldest first."""
    fs, path = _files(spark, root)
    if not fs.exists(path):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(path)]
    done = [n for n in names if re.fullmatch(r"gen=\d{8}", n)
            and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{n}/_SUCCESS"))]
    return [f"{root}/{n}" for n in sorted(done)]


def write_generation(
    df: DataFrame, root: str, keep: int = 2, kind: str = "parquet", partition_by: Sequence[str] = (),
) -> str:
    """Write a new generation of a table, then drop all but the last ``keep``.

    Readers see the old generation until the new one is complete, so a failed
    write changes nothing, and a table can be rebuilt from itself.
    """
    spark = df.sparkSession
    fs, path = _files(spark, root)
    taken = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    numbers = [int(n[4:]) for n in taken if re.fullmatch(r"gen=\d{8}", n)]
    target = f"{root}/gen={max(numbers, default=0) + 1:08d}"
    writer = df.write.format(kind)
    (writer.partitionBy(*partition_by) if partition_by else writer).save(target)
    for old in generations(spark, root)[:-keep]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)
    return target


def read_generation(spark: SparkSession, root: str, back: int = 0, kind: str = "parquet", schema=None) -> DataFrame:
    """Latest generation of a table, or one ``back`` steps before it."""
    reader = spark.read.format(kind)
    return (reader.schema(schema) if schema else reader).load(generations(spark, root)[-1 - back])


def refresh(df: DataFrame, root: str) -> str:
    """Replace a whole table."""
    return write_generation(df, root, keep=1)


def upsert(target: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of ``target`` with those of ``incoming`` put in by key.

    The last of several incoming rows of a key wins, by ``order``, which is
    dropped from the result: a number that no two rows of a key share, such as
    the one that the readers give for file and place in the file. Rows without
    a key cannot be put in; loads keep them apart with a reason beforehand.
    """
    latest = last_rows(incoming, key, order)
    kept = target.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest)


def last_rows(incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Last row of each present key by ``order``."""
    return last_by_key(incoming.where(F.col(key).isNotNull()), key, order).drop(order)


def upsert_listings(target: DataFrame, incoming: DataFrame, order: str) -> DataFrame:
    """Listings put in by their web address; the last of several rows wins, by ``order``.

    Known listings keep their id and, where the new row has none, their
    coordinates. New ones are numbered after the highest id, in the hash order
    of their address.
    """
    latest = last_rows(incoming, "property_url", order)
    held = target.select("property_url", F.struct("id", "latitude", "longitude").alias("_old"))
    joined = saved(latest.drop("id").join(held, "property_url", "left"), "incoming")
    known = joined.where(F.col("_old").isNotNull()).withColumn("id", F.col("_old.id"))
    highest = one_row(target.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top")))
    fresh = hash_rank(joined.where(F.col("_old").isNull()), "property_url", rank="_rank", total="_rows")
    fresh = fresh.withColumn("id", highest["top"] + F.col("_rank") + 1).drop("_rank", "_rows")
    ready = known.unionByName(fresh).withColumns({
        "latitude": F.coalesce("latitude", "_old.latitude"),
        "longitude": F.coalesce("longitude", "_old.longitude"),
    }).select(*target.columns)
    return target.join(ready.select("property_url"), "property_url", "left_anti").unionByName(ready)


def historical_rows(raw: DataFrame) -> DataFrame:
    """Registry file rows as the historical table, with a ``reason`` where they are invalid.

    Prices may be texts. Codes outside their domain, unreadable dates and
    missing ids make a row invalid; nothing is raised.
    """
    named = raw.select(
        F.col("Unique Transaction Identifier").alias("id"),
        text.price_number(F.col("Price").cast("string")).cast("bigint").alias("price"),
        F.to_date(dates.parsed_timestamp(F.col("Date of Transaction").cast("string"))).alias("date_of_transaction"),
        F.col("Postal Code").alias("postal_code"),
        F.col("Property Type").alias("property_type"),
        F.col("Old/New").alias("property_age"),
        F.col("Duration").alias("duration"),
        F.col("PAON").alias("paon"), F.col("SAON").alias("saon"), F.col("Street").alias("street"),
        F.col("Locality").alias("locality"), F.col("`Town/City`").alias("town_city"), F.col("District").alias("district"),
        F.col("PPD Category Type").alias("ppd_category_type"), F.col("Record Status").alias("record_status"),
        *carried_order(raw),
    )
    return named.withColumn("reason", invalid_reason())


def carried_order(raw: DataFrame) -> list[Column]:
    """The readers' order column, where a frame has it."""
    return [F.col(ORDER)] if ORDER in raw.columns else []


def invalid_reason(domains: dict[str, list[str]] | None = None) -> Column:
    """First rule a historical row breaks, null for a valid row."""
    rules = [F.when(F.col("id").isNull(), "missing id"), F.when(F.col("date_of_transaction").isNull(), "bad date")]
    for column, values in (domains or schemas.DOMAINS).items():
        rules.append(F.when(~F.coalesce(F.col(column).isin(values), F.lit(False)), f"bad {column}"))
    return F.coalesce(*rules)


def listing_rows(raw: DataFrame, county: Column | None = None) -> DataFrame:
    """Scraped records as listings, with a ``reason`` where they cannot be stored."""
    named = raw.withColumns({
        "price": text.price_number(F.col("price")),
        "tenure": text.tenure_of(F.col("features")),
        "county": county if county is not None else F.col("county"),
        "latitude": F.col("latitude") if "latitude" in raw.columns else F.lit(None).cast("double"),
        "longitude": F.col("longitude") if "longitude" in raw.columns else F.lit(None).cast("double"),
    })
    reason = (
        F.when(F.col("price").isNull(), "skipped: no price")
        .when(F.col("property_url").isNull(), "error: no address on the web")
        .when(F.col("title").isNull() | F.col("address").isNull() | F.col("property_type").isNull(), "error: incomplete")
    )
    return named.select(*schemas.LISTING.fieldNames(), *carried_order(raw), reason.alias("reason"))


def valid_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("reason").isNull()).drop("reason")


def quarantined_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col("reason").isNotNull())


def load_summary(df: DataFrame) -> DataFrame:
    """Rows per outcome of a load: processed, skipped and error."""
    status = F.when(F.col("reason").isNull(), "processed").when(F.col("reason").startswith("skipped"), "skipped").otherwise("error")
    return df.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def geocoded_rows(raw: DataFrame, types: dict[str, str], single_quoted: bool = False, key: str = "id") -> DataFrame:
    """Text rows of a pre-geocoded file in the types of their table, with a ``reason`` where they cannot be stored.

    Features are JSON lists, for listings with single quotes; malformed lists
    and unreadable dates or numbers become null. A row without a readable id
    has no place in the table, which makes it an error.
    """
    built = {}
    for name in raw.columns:
        if name == ORDER:
            value = F.col(name)
        elif name == "features":
            value = parsed_list(F.col(name), single_quoted)
        elif types.get(name) == "date":
            value = dates.parsed_date(F.col(name))
        elif types.get(name) == "bigint":
            value = F.col(name).try_cast("double").try_cast("bigint")
        else:
            value = F.col(name).try_cast(types.get(name, "string"))
        built[name] = value
    reason = F.when(F.col(key).isNull(), "error: missing id").when(built[key].isNull(), "error: unreadable id")
    return raw.select(*[v.alias(n) for n, v in built.items()], reason.alias("reason"))


def coordinates_complete(df: DataFrame) -> bool:
    """Whether a frame has both coordinates on every row."""
    if not {"latitude", "longitude"} <= set(df.columns):
        return False
    return df.agg(F.count_if(F.col("latitude").isNull() | F.col("longitude").isNull()).alias("n")).first()["n"] == 0


def file_complete(spark: SparkSession, path: str) -> bool:
    """Whether a prepared file exists and has both coordinates on every row."""
    fs, found = _files(spark, path)
    if not fs.exists(found):
        return False
    return coordinates_complete(with_numbers(read_csv(spark, path)))


def with_numbers(df: DataFrame) -> DataFrame:
    """Coordinates of a text frame as numbers."""
    present = [c for c in ("latitude", "longitude") if c in df.columns]
    return df.withColumns({c: F.col(c).try_cast("double") for c in present}) if present else df
