"""Batch writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from veristream.functions.times import now_z


def export_csv(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """CSV with a header, columns in the given order, plain UTF-8."""
    chosen = df.select(*columns) if columns else df
    chosen.write.mode("overwrite").option("escape", '"').csv(path, header=True)


def append_log(df: DataFrame, path: str) -> None:
    """Add prediction rows (text, label, scores) to a JSON-lines log."""
    df.select("text", "label", F.col("all_scores").alias("scores")).write.mode("append").json(path)


def manifest(df: DataFrame, source: str, label: str, now: Column | None = None) -> DataFrame:
    """One row about a load: when, how many rows, source and label."""
    return df.agg(F.count("*").alias("total_articles")).select(
        (now_z() if now is None else now).alias("downloaded_at"),
        "total_articles",
        F.lit(source).alias("source"),
        F.lit(label).alias("label"),
    )


def write_manifest(df: DataFrame, path: str, source: str, label: str) -> None:
    manifest(df, source, label).write.mode("overwrite").json(path)
