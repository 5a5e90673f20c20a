"""Dashboard aggregates over the live feed.

Group keys such as ``source`` may be very uneven; every aggregate here is
partial before its shuffle, so a hot key costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from veristream import fixed_values as fv
from veristream.functions import labels, text as tx, times
from veristream.functions.scoring import pct


def between(df: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Optional range of the time text, start included, end excluded."""
    if start is not None:
        df = df.filter(F.col("timestamp") >= start)
    if end is not None:
        df = df.filter(F.col("timestamp") < end)
    return df


def _points(df: DataFrame, empty_label: str) -> DataFrame:
    """(label, value) rows; one zero point where there are none.

    Points are few by nature (hours of a day, a top list), so they pass through
    one list.
    """
    points = df.agg(F.collect_list(F.struct("label", "value")).alias("_p"))
    return points.select(F.inline(_or_zero_point("_p", empty_label)))


def _or_zero_point(points: str, empty_label: str) -> Column:
    zero = F.struct(F.lit(empty_label).alias("label"), F.lit(0).cast("bigint").alias("value"))
    return F.when(F.size(points) > 0, F.col(points)).otherwise(F.array(zero))


def total(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def _label_count(name: str) -> Column:
    return F.count_if(F.coalesce(F.col("label") == name, F.lit(False)))


def label_counts(df: DataFrame) -> DataFrame:
    """One row per class, zero where absent; other labels are left out.

    A single global aggregate unpivoted to rows: no join, no driver loop.
    """
    counted = df.agg(*[_label_count(name).alias(name) for name in fv.LABELS])
    return counted.unpivot([], fv.LABELS, "label", "n")


def log_stats(df: DataFrame) -> DataFrame:
    """Total of all log rows and the count of each class; no label means Valid."""
    defaulted = df.select(F.coalesce("label", F.lit("Valid")).alias("label"))
    return defaulted.agg(
        F.count("*").alias("total_predictions"), *[_label_count(k).alias(k) for k in fv.LABELS]
    )


def label_share(df: DataFrame) -> DataFrame:
    """Percent valid, hoaks and scam of all rows in the four classes."""
    counted = df.agg(
        *[_label_count(k).alias(k) for k in fv.LABELS],
        F.count_if(labels.in_domain(F.col("label"))).alias("_known"),
    )
    return counted.select(
        pct(F.col("Valid"), F.col("_known")).alias("valid"),
        pct(F.col("Hoaks"), F.col("_known")).alias("hoaks"),
        pct(F.col("Penipuan"), F.col("_known")).alias("scam"),
    )


def active_sources(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Number of distinct sources, exact unless told otherwise."""
    count = F.approx_count_distinct("source") if approximate else F.count_distinct("source")
    return df.agg(count.alias("active_sources"))


def hourly_volume(df: DataFrame) -> DataFrame:
    """Rows per hour of day, in order of the hour."""
    hours = (
        df.filter(F.col("timestamp").isNotNull())
        .groupBy(times.hour_label(F.col("timestamp")).alias("label"))
        .agg(F.count("*").alias("value"))
    )
    return _points(hours, "00").orderBy("label")


def risk_sources(df: DataFrame, n: int = 6) -> DataFrame:
    """The ``n`` sources with most risky rows."""
    named = F.coalesce(tx.non_empty(F.col("source")), F.lit("Unknown"))
    top = (
        df.filter(labels.is_risk(F.col("label")))
        .groupBy(named.alias("label"))
        .agg(F.count("*").alias("value"))
        .orderBy(F.col("value").desc(), "label")
        .limit(n)
    )
    return _points(top, "None").orderBy(F.col("value").desc(), "label")


def risk_share(top: DataFrame) -> DataFrame:
    """Share of each source in the (short) top list, in whole percent."""
    whole = F.sum("value").over(Window.partitionBy())
    return top.select(
        "label",
        "value",
        F.round(F.col("value") / F.greatest(whole, F.lit(1)) * 100).cast("int").alias("percent"),
    )


def bar_heights(points: DataFrame) -> DataFrame:
    """Height of each (hourly) bar relative to the highest, in percent."""
    highest = F.max("value").over(Window.partitionBy())
    return points.select(
        "label",
        "value",
        F.round(F.col("value") / F.greatest(highest, F.lit(1)) * 100, 2).alias("height"),
    )


def snapshot(df: DataFrame, n: int = 6, now: Column | None = None) -> DataFrame:
    """The whole dashboard as one row with nested point lists.

    One base aggregate by (source, hour, label) feeds all parts; its shuffle is
    shared, so the feed is scanned once.  The parts come together as tagged
    rows of a union and one final aggregate.
    """
    base = df.groupBy(
        "source", "label", times.hour_label(F.col("timestamp")).alias("hour")
    ).agg(F.count("*").alias("n"))

    def n_if(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n")).otherwise(0)), F.lit(0))

    # No filters below this line touch the base, or its shuffle would differ.
    scalars = base.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_messages_today"),
        *[n_if(F.col("label") == k).alias(k) for k in fv.LABELS],
        F.count_distinct("source").alias("active_sources"),
    )
    hours = base.groupBy("hour").agg(F.sum("n").alias("value"))
    point = F.struct(F.col("hour").alias("label"), F.col("value"))
    hours = hours.agg(
        F.sort_array(F.collect_list(F.when(F.col("hour").isNotNull(), point))).alias("hourly_volume")
    )
    named = F.coalesce(tx.non_empty(F.col("source")), F.lit("Unknown"))
    risky = (
        base.groupBy(named.alias("label"))
        .agg(n_if(labels.is_risk(F.col("label"))).alias("value"))
        .filter("value > 0")
        .orderBy(F.col("value").desc(), "label")
        .limit(n)
        .agg(
            F.sort_array(
                F.collect_list(F.struct((-F.col("value")).alias("down"), "label", "value"))
            ).alias("_risk")
        )
        .select(
            F.transform("_risk", lambda p: F.struct(p["label"], p["value"])).alias("risk_scatter")
        )
    )
    parts = scalars.unionByName(hours, allowMissingColumns=True).unionByName(
        risky, allowMissingColumns=True
    )
    row = parts.agg(*[F.any_value(c, True).alias(c) for c in parts.columns])
    known = sum((F.col(k) for k in fv.LABELS[1:]), F.col(fv.LABELS[0]))

    return row.select(
        "total_messages_today",
        F.col("Hoaks").alias("hoax_detected_today"),
        F.col("Penipuan").alias("scam_detected_today"),
        F.col("Valid").alias("valid_detected_today"),
        F.struct(
            pct(F.col("Valid"), known).alias("valid"),
            pct(F.col("Hoaks"), known).alias("hoaks"),
            pct(F.col("Penipuan"), known).alias("scam"),
        ).alias("hoax_vs_valid_percent"),
        "active_sources",
        (times.now_z() if now is None else now).alias("last_updated"),
        _or_zero_point("hourly_volume", "00").alias("hourly_volume"),
        _or_zero_point("risk_scatter", "None").alias("risk_scatter"),
    )
