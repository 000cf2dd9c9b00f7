"""Filling of missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F
from pyspark.sql import types as T

from homematch import schemas
from homematch.functions import arrays, numbers, text
from homematch.operators.filters import numeric_columns
from homematch.operators.joins import join_statistics
from homematch.operators.ranking import exact_medians, modes
from homematch.session import saved

KEY_COLUMNS = ("id", "listing_id", "historical_id")


def columns_lacking(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Columns that hold a null, found in one pass over the frame."""
    if not columns:
        return []
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c]]


def _median_columns(df: DataFrame, columns: Sequence[str], figures: Row) -> dict[str, Column]:
    return {c: F.coalesce(F.col(c).cast("double"), F.lit(figures[c]).cast("double")) for c in columns}


def fill_medians(df: DataFrame, columns: Sequence[str], only_lacking: bool = False) -> DataFrame:
    """Fill numeric columns with their exact median; a column without values stays null.

    The medians, one number per column, are taken first. ``only_lacking`` first counts the nulls, so that medians are taken for the
    columns that need one.
    """
    present = [c for c in columns if c in df.columns]
    wanted = columns_lacking(df, present) if only_lacking else present
    if not wanted:
        return df
    return df.withColumns(_median_columns(df, wanted, exact_medians(df, wanted).first()))


def fill_numeric(df: DataFrame, exclude: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Fill every numeric column that is no key with its median."""
    return fill_medians(df, [c for c in numeric_columns(df) if c not in exclude])


def fill_modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fill columns with their most frequent value; an empty text column becomes Unknown."""
    if not columns:
        return df
    return df.withColumns(_mode_columns(df, columns, modes(df, columns).first()))


def _mode_columns(df: DataFrame, columns: Sequence[str], figures: Row) -> dict[str, Column]:
    filled = {}
    for c in columns:
        kind = df.schema[c].dataType
        value = figures[c] if figures[c] is not None or not isinstance(kind, T.StringType) else "Unknown"
        filled[c] = F.coalesce(F.col(c), F.lit(value).cast(kind))
    return filled


def plain_columns(df: DataFrame, exclude: Sequence[str] = KEY_COLUMNS) -> list[str]:
    """Text and date columns that take their mode."""
    kinds = (T.StringType, T.DateType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in {*exclude, "size", "features"}]


def fill_categorical(df: DataFrame, exclude: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Fill text, date and list columns.

    The size loses its missing-value text, a missing feature list becomes empty,
    every other column takes its mode.
    """
    return fill_modes(_special_filled(df), plain_columns(df, exclude))


def _special_filled(df: DataFrame) -> DataFrame:
    replaced: dict[str, Column] = {}
    if "size" in df.columns:
        replaced["size"] = text.size_or_null(F.col("size"))
    if "features" in df.columns:
        replaced["features"] = arrays.list_or_empty(F.col("features"))
    return df.withColumns(replaced) if replaced else df


def fill_group_median(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    """Fill a column with the median of its group.

    Rows without a group key keep their value and wait for the next level.
    """
    medians = exact_medians(df, [column], keys).withColumnRenamed(column, "_median")
    joined = join_statistics(df, medians, keys)
    return joined.withColumn(column, F.coalesce(column, "_median")).select(*df.columns)


def fill_by_levels(df: DataFrame, column: str, levels: Sequence[Sequence[str]]) -> DataFrame:
    """Fill a column by group medians, each level taken after the one before, then overall.

    Levels go from fine to coarse; each one uses keys of the first. The rows are
    read once into counts per keys and value. All medians come from those
    counts, and one join on the finest keys brings the result back.
    """
    keys = list(levels[0])
    counts = df.groupBy(*keys, F.col(column).cast("double").alias("_value")).agg(F.count(F.lit(1)).alias("_n"))
    counts = saved(counts, "counts").withColumn("_filled", F.col("_value"))
    fills = counts.select(*keys).distinct().withColumn("_fill", F.lit(None).cast("double"))
    for level in levels:
        medians = saved(exact_medians(counts, ["_filled"], level, "_n").withColumnRenamed("_filled", "_median"), "medians")
        counts = _take_median(counts, medians, level, "_filled")
        fills = _take_median(fills, medians, level, "_fill")
    overall = exact_medians(counts, ["_filled"], weight="_n").first()["_filled"]
    fills = fills.withColumn("_fill", F.coalesce("_fill", F.lit(overall).cast("double")))
    joined = join_statistics(df, fills, keys)
    return joined.withColumn(column, F.coalesce(F.col(column).cast("double"), "_fill")).select(*df.columns)


def _take_median(counts: DataFrame, medians: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    return counts.join(medians, list(keys), "left").withColumn(column, F.coalesce(column, "_median")).select(*counts.columns)


def fill_size(df: DataFrame, size: str = "size", result: str = "size_sq_ft") -> DataFrame:
    """Square feet from the size text, filled by type and bedrooms, by type, then overall."""
    sized = df.withColumn(result, text.square_feet(F.col(size)))
    return fill_by_levels(sized, result, [["property_type", "bedrooms"], ["property_type"]])


def fill_coordinate_medians(df: DataFrame, columns: Sequence[str] = ("latitude", "longitude")) -> DataFrame:
    """Read columns as numbers, bad texts as missing, and fill them with the median."""
    read = df.withColumns({c: numbers.number_or_null(F.col(c)) for c in columns})
    return fill_medians(read, columns)


def handle_missing(df: DataFrame) -> DataFrame:
    """All filling steps of the merged table, in their fixed order.

    Medians and modes of the first two steps concern different columns, so both
    come from the table as it is and are applied together. Rooms and coordinates stored as numbers are complete after the first step
    and are not filled a second time.
    """
    numeric = [c for c in numeric_columns(df) if c not in KEY_COLUMNS]
    plain = plain_columns(df)
    medians, common = exact_medians(df, numeric).first(), modes(df, plain).first()
    filled = _special_filled(df).withColumns({**_median_columns(df, numeric, medians), **_mode_columns(df, plain, common)})
    filled = fill_size(filled)
    filled = fill_medians(filled, [c for c in ("bedrooms", "bathrooms") if c not in numeric])
    places = [c for c in ("latitude", "longitude") if c in df.columns and c not in numeric]
    return fill_coordinate_medians(filled, places) if places else filled


def fill_generic(df: DataFrame, only_lacking: bool = False) -> DataFrame:
    """Numeric columns by median, all others by mode or Unknown."""
    numeric = numeric_columns(df)
    others = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.DateType))]
    return fill_modes(fill_medians(df, numeric, only_lacking), others)


def type_label() -> Column:
    """Property class rebuilt from its flags."""
    return text.flag_label(dict(zip(schemas.TYPE_FLAGS, schemas.TYPE_FLAGS)))


def fill_pair_size(df: DataFrame, column: str = "size_sq_ft") -> DataFrame:
    """Fill the size of pairs by the median of the property class, then overall."""
    labelled = df.withColumn("_class", type_label())
    return fill_by_levels(labelled, column, [["_class"]]).select(*df.columns)


def fill_features(df: DataFrame, numeric: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """Numeric features by median, flags as 0 where missing."""
    read = df.withColumns({c: F.col(c).cast("double") for c in numeric})
    filled = fill_medians(read, numeric, only_lacking=True)
    return filled.withColumns({c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in flags})
