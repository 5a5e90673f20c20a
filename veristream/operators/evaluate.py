"""Classification measures.

All of them come from the table of (truth, prediction) counts, so the data is
read once and only a handful of rows go further.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def pair_counts(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    return df.groupBy(F.col(truth).alias("y"), F.col(predicted).alias("p")).agg(
        F.count("*").alias("n")
    )


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def _per_class(df: DataFrame, truth: str, predicted: str) -> DataFrame:
    counts = pair_counts(df, truth, predicted)
    # Each count goes to the row of its truth and to the row of its prediction.
    sides = counts.select(
        F.explode(
            F.array(
                F.struct(F.col("y").alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("said"),
                         F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).cast("bigint").alias("tp")),
                F.struct(F.col("p").alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("said"),
                         F.lit(0).cast("bigint").alias("tp")),
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("said").alias("said"), F.sum("support").alias("support")
    )
    precision, recall = _ratio(F.col("tp"), F.col("said")), _ratio(F.col("tp"), F.col("support"))
    return sums.select("label", "tp", "support", precision.alias("precision"), recall.alias("recall")).withColumn(
        "f1",
        _ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")),
    )


def _weighted(c: str) -> Column:
    return _ratio(F.sum(F.col(c) * F.col("support")), F.sum("support"))


def summary(df: DataFrame, truth: str = "label_num", predicted: str = "prediction") -> DataFrame:
    """One row: accuracy and weighted F1."""
    return _per_class(df, truth, predicted).agg(
        _ratio(F.sum("tp"), F.sum("support")).alias("accuracy"), _weighted("f1").alias("f1_weighted")
    )


def report(df: DataFrame, truth: str = "label_num", predicted: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class, then both averages."""
    classes = _per_class(df, truth, predicted)
    measures = ["precision", "recall", "f1"]
    macro = classes.agg(
        F.lit("macro avg").alias("label"),
        *[F.avg(m).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    weighted = classes.agg(
        F.lit("weighted avg").alias("label"),
        *[_weighted(m).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    rows = classes.select(F.col("label").cast("string").alias("label"), *measures, "support")
    return rows.unionByName(macro).unionByName(weighted)


def confusion(
    df: DataFrame, truth: str = "label_num", predicted: str = "prediction", classes=(0, 1, 2, 3)
) -> DataFrame:
    """One row per true class, one column ``p<class>`` per predicted class."""
    columns = [
        F.count_if(F.col(predicted) == k).alias(f"p{k}") for k in classes
    ]
    return df.groupBy(F.col(truth).alias("label")).agg(*columns)
