"""Counts, distributions and column profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from homematch.operators.filters import numeric_columns
from homematch.operators.joins import with_row
from homematch.operators.ranking import exact_quantiles, top_per_group, value_counts


def counts_by(df: DataFrame, column: str, count: str = "n") -> DataFrame:
    """Rows per value, largest first."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias(count)).orderBy(F.desc(count), column)


def coverage(**tables: DataFrame) -> DataFrame:
    """Rows, and rows with both coordinates, of each table."""
    both = F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    parts = [
        df.agg(F.count(F.lit(1)).alias("total"), F.count_if(both).alias("with_coordinates")).select(F.lit(name).alias("source"), "*")
        for name, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _tall(df: DataFrame, values: dict[str, dict[str, Column]]) -> DataFrame:
    """One aggregation pass turned into one row per column."""
    row = df.agg(*[
        F.struct(*[v.alias(k) for k, v in {"column": F.lit(name), **figures}.items()]).alias(f"_{i}")
        for i, (name, figures) in enumerate(values.items())
    ])
    return row.select(F.inline(F.array(*[f"_{i}" for i in range(len(values))])))


def null_counts(df: DataFrame, columns: Sequence[str] | None = None, missing: Sequence[str] = ()) -> DataFrame:
    """Missing values per column; texts in ``missing`` count as well."""
    def lacking(c: str) -> Column:
        test = F.col(c).isNull()
        return test | F.col(c).cast("string").isin(list(missing)) if missing else test

    return _tall(df, {c: {"missing": F.count_if(F.coalesce(lacking(c), F.lit(True)))} for c in columns or df.columns})


def numeric_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, minimum, maximum, mean, sample deviation and exact median per column."""
    figures = _tall(df, {
        c: {
            "present": F.count(F.col(c)),
            "minimum": F.min(F.col(c).cast("double")),
            "maximum": F.max(F.col(c).cast("double")),
            "mean": F.avg(F.col(c).cast("double")),
            "deviation": F.stddev_samp(F.col(c).cast("double")),
        }
        for c in columns
    })
    medians = exact_quantiles(df, columns, [0.5]).select("column", F.col("value").alias("median"))
    return figures.join(medians, "column", "left")


def text_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values, most frequent value (smallest on ties) and its count per column."""
    best = value_counts(df, columns).groupBy("column").agg(
        F.sum("n").alias("present"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.min(F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("_top"),
    )
    return best.select(
        "column", "present", "distinct_values",
        F.col("_top.value").alias("top"), (-F.col("_top.n")).alias("top_count"),
    )


def class_distribution(df: DataFrame, label: str) -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(F.col(label).cast("int").alias("label")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))


def shares(df: DataFrame, conditions: dict[str, Column]) -> DataFrame:
    """Share of rows that meet each condition."""
    return _tall(df, {name: {"share": F.avg(test.cast("double"))} for name, test in conditions.items()})


def distinct_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact distinct values per column; equal values collapse before the shuffle."""
    found = value_counts(df, columns).groupBy("column").agg(F.count(F.lit(1)).alias("distinct_values"))
    return _names(df, columns).join(found, "column", "left").na.fill({"distinct_values": 0})


def _names(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column name, whatever the frame holds."""
    return df.agg(F.array(*[F.lit(c) for c in columns]).alias("c")).select(F.explode("c").alias("column"))


def describe_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Full description, one row per column; figures that do not apply are null.

    Whatever is no number, such as dates, booleans and lists, is described by its
    text: distinct values and the most frequent one.
    """
    chosen = list(columns or df.columns)
    numeric = [c for c in numeric_columns(df) if c in chosen]
    texts = [c for c in chosen if c not in numeric]
    result = None
    if numeric:
        points = {0.25: "q25", 0.5: "q50", 0.75: "q75"}
        tall = exact_quantiles(df, numeric, list(points))
        wide = tall.groupBy("column").agg(*[F.max(F.when(F.col("point") == p, F.col("value"))).alias(n) for p, n in points.items()])
        result = numeric_profile(df, numeric).drop("median").join(wide, "column", "left")
    if texts:
        words = _names(df, texts).join(text_profile(df, texts), "column", "left").na.fill({"present": 0, "distinct_values": 0})
        result = words if result is None else result.unionByName(words, allowMissingColumns=True)
    return result


def inspect(df: DataFrame, label: str, columns: Sequence[str]) -> DataFrame:
    """Description and missing values of each column, numbers and others, with the label's positives and their share on each row."""
    figures = describe_all(df, columns).join(null_counts(df, columns), "column")
    return with_row(figures, df.agg(F.sum(label).alias("positives"), F.avg(label).alias("ratio")), "_label").select(*figures.columns, "_label.*")


def unique_values(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """First ``n`` distinct values of each column in value order, with their total number."""
    counts = value_counts(df, columns)
    totals = counts.groupBy("column").agg(F.count(F.lit(1)).alias("total"))
    first = top_per_group(counts, ["column"], [F.col("value")], n)
    return first.select("column", "position", "value").join(F.broadcast(totals), "column")


def shape(df: DataFrame) -> DataFrame:
    """Number of rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)).cast("bigint"))
