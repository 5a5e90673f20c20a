"""Record checks: rows that pass, and rows that fail with the reasons."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from veristream import fixed_values as fv

Rules = Mapping[str, Column]


def _length(column: str, low: int, high: int) -> Column:
    return F.length(column).between(low, high)


def scam_record_rules() -> Rules:
    return {
        "identifier_type": F.col("identifier_type").isin(fv.IDENTIFIER_TYPES),
        "identifier_value": _length("identifier_value", *fv.IDENTIFIER_LENGTH),
        "owner_name": _length("owner_name", *fv.OWNER_LENGTH),
        "source": _length("source", *fv.SOURCE_LENGTH),
        "report_count": F.col("report_count") >= 0,
        "status": F.col("status").isin(fv.RECORD_STATUS),
        "notes": F.col("notes").isNull() | (F.length("notes") <= fv.NOTES_LENGTH),
    }


def live_feed_rules() -> Rules:
    return {
        "source_type": F.col("source_type").isin(fv.SOURCE_TYPES),
        "label": F.col("label").isin(fv.FEED_LABELS),
        "confidence": F.col("confidence").between(0, 100),
        **{
            c: F.col(c).isNotNull() for c in ("id", "timestamp", "source", "text_snippet", "topic")
        },
    }


def share_rules() -> Rules:
    return {c: F.col(c).between(0, 100) for c in ("valid", "hoaks", "scam")}


def check(df: DataFrame, rules: Rules) -> DataFrame:
    """Adds ``reasons``, the names of the rules a row breaks (null breaks)."""
    broken = [
        F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()
    ]
    return df.withColumn("reasons", F.filter(F.array(*broken), lambda r: r.isNotNull()))


def split_valid(df: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """(rows that pass, rows that fail with ``reasons``)."""
    checked = check(df, rules)
    ok = checked.filter(F.size("reasons") == 0).drop("reasons")
    return ok, checked.filter(F.size("reasons") > 0)


def assert_classes(df: DataFrame, label: str = "final_label", n: int = len(fv.LABELS)) -> DataFrame:
    """One row with the number of classes; the query fails if it is not ``n``."""
    counted = df.agg(F.count_distinct(label).alias("n_classes"))
    message = F.concat(
        F.lit("classes found: "), F.col("n_classes").cast("string"), F.lit(f", wanted: {n}")
    )
    wrong = F.col("n_classes") != n
    return counted.select(
        F.when(wrong, F.raise_error(message).cast("bigint")).otherwise(F.col("n_classes")).alias("n_classes")
    )
