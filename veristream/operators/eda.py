"""Looking at data: value shares, length statistics, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def value_counts(df: DataFrame, column: str, normalize: bool = False) -> DataFrame:
    """Count per value, most frequent first; as a share if asked.

    The total is a scalar subquery, so even many distinct values stay spread
    over the cluster.
    """
    filled = df.filter(F.col(column).isNotNull())
    counts = filled.groupBy(column).agg(F.count("*").alias("n"))
    if normalize:
        whole = filled.agg(F.count("*").alias("n")).scalar()
        counts = counts.select(column, (F.col("n") / whole).alias("share"))
        return counts.orderBy(F.col("share").desc(), column)
    return counts.orderBy(F.col("n").desc(), column)


def describe(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, std, min, quartiles and max of text lengths."""
    return describe_values(df.select(F.length(column).alias("len")), "len")


def describe_values(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, std, min, quartiles and max of whole numbers.

    Rows are first counted per value, so the quartiles are taken from a short
    frequency table, and so is the variance, in a second pass about the mean:
    the sum of squares would cancel where values are large and close.
    """
    counts = (
        df.select(F.col(column).alias("len"))
        .filter(F.col("len").isNotNull())
        .groupBy("len")
        .agg(F.count("*").alias("n"))
    )
    n, x = F.col("n"), F.col("len").cast("double")
    # Against the least value, so that the mean itself loses nothing either.
    facts = counts.agg(F.min("len").alias("least"), F.sum("n").alias("rows"))
    least = facts.select("least").scalar().cast("double")
    mean = counts.agg((F.sum(n * (x - least)) / F.sum("n"))).scalar()
    sums = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count"),
        (F.max(least) + F.max(mean)).alias("mean"),
        F.sum(n * (x - least - mean) * (x - least - mean)).alias("_q"),
        F.min("len").alias("min"),
        F.percentile("len", [0.25, 0.5, 0.75], F.col("n")).alias("_p"),
        F.max("len").alias("max"),
    )
    return sums.select(
        "count",
        "mean",
        F.sqrt(F.col("_q") / F.nullif(F.col("count") - 1, F.lit(0))).alias("std"),
        F.col("min").cast("double").alias("min"),
        F.col("_p")[0].alias("p25"),
        F.col("_p")[1].alias("p50"),
        F.col("_p")[2].alias("p75"),
        F.col("max").cast("double").alias("max"),
    )


def samples(
    df: DataFrame, n: int, label: str, order: str, text: str = "text", chars: int = 200
) -> DataFrame:
    """First ``n`` texts of each class, cut to 200 characters."""
    first = Window.partitionBy(label).orderBy(order)
    return (
        df.select(label, order, F.substring(text, 1, chars).alias("sample"))
        .withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
    )
