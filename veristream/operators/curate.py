"""Bronze to silver: label mapping per source, union, deduplication."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from veristream import fixed_values as fv
from veristream.functions import labels, text as tx
from veristream.operators.sampling import seeded_hash


def drop_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def min_length(df: DataFrame, n: int, column: str = "text") -> DataFrame:
    """Texts with more than ``n`` characters."""
    return df.filter(F.length(column) > n)


def coalesce_cols(df: DataFrame, columns: Sequence[str]) -> Column:
    """First non-null of those columns that the table has."""
    present = [F.col(f"`{c}`") for c in columns if c in df.columns]
    return F.coalesce(*present)


def pick_column(df: DataFrame, candidates: Sequence[str] = tuple(fv.TEXT_COLUMN_CANDIDATES)) -> str:
    """First candidate the table has, else its first column."""
    return next((c for c in candidates if c in df.columns), df.columns[0])


def ocr_rows(df: DataFrame) -> DataFrame:
    """Picture readings with a text and the scam category, as labelled text."""
    text = tx.strip(F.coalesce("text", F.lit("")))
    return df.filter((text != "") & (F.upper("kategori") == "PENIPUAN")).select(
        text.alias("text"),
        F.lit("Penipuan").alias("final_label"),
        F.lit("ocr_screenshot").alias("source"),
    )


# --- one projection per source ---------------------------------------------
# ``keep`` carries columns such as a row id through to ordering.


def _labeled(df: DataFrame, text: Column, label: Column, keep: Sequence[str]) -> DataFrame:
    out = df.select(
        text.cast("string").alias("text"), label.alias("final_label"), "source", *keep
    )
    return drop_null(out, ["text", "final_label", "source"])


def silver_sms(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _labeled(df, F.col("Teks"), labels.from_sms(F.col("label")), keep)


def silver_kaggle(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    text = coalesce_cols(df, ["text_new", "Clean Narasi", "FullText"])
    return _labeled(df, text, labels.from_flag(F.col("hoax")), keep)


def silver_synthetic(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _labeled(df, F.col("text"), F.col("label_raw"), keep)


def silver_komdigi(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    text = tx.join_title(F.col("title"), F.col("body_text"), ". ")
    return _labeled(df, text, F.lit("Hoaks"), keep)


def silver_vijayandika(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    text = F.col(f"`{pick_column(df)}`")
    if "source" not in df.columns:
        df = df.withColumn("source", F.lit("vijayandika"))
    return _labeled(df, text, F.lit("Hoaks"), keep)


def silver_ocr(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return _labeled(df, F.col("text"), F.col("final_label"), keep)


SILVER = {
    "sms": silver_sms,
    "kaggle": silver_kaggle,
    "synthetic": silver_synthetic,
    "komdigi": silver_komdigi,
    "vijayandika": silver_vijayandika,
    "ocr": silver_ocr,
}


# --- union and deduplication ------------------------------------------------


def dedup_keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key, the first in the given order.

    Long keys are compared by their SHA-256.  The limit of one row per key is
    applied in every task before the shuffle as well, so a text with millions
    of copies sends one row per task.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("\x00null")) for k in keys]
    digest = F.sha2(F.concat_ws("\x1f", *parts), 256)
    first = Window.partitionBy("_digest").orderBy(*order)
    return (
        df.withColumn("_digest", digest)
        .withColumn("_rank", F.row_number().over(first))
        .filter("_rank = 1")
        .drop("_digest", "_rank")
    )


def union_sources(
    sources: Mapping[str, DataFrame], row_id: str = "row_id"
) -> DataFrame:
    """Silver projections of the given sources, one under the other.

    Adds ``source_rank``, the place of the source in the fixed order.
    """
    out = None
    for rank, name in enumerate(fv.SILVER_ORDER):
        if name not in sources:
            continue
        keep = [row_id] if row_id in sources[name].columns else []
        part = SILVER[name](sources[name], keep)
        if not keep:
            # No order of its own: any order that does not change will do.
            part = part.withColumn(row_id, F.xxhash64("text", "final_label", "source"))
        part = part.withColumns(
            {"source_rank": F.lit(rank), row_id: F.col(row_id).cast("bigint")}
        )
        out = part if out is None else out.unionByName(part)
    return out


def build_silver(sources: Mapping[str, DataFrame], row_id: str = "row_id") -> DataFrame:
    """All sources, texts longer than 30 characters, one row per text.

    Length depends on the text alone, so short texts go before the shuffle.
    """
    union = min_length(union_sources(sources, row_id), fv.MIN_SILVER_CHARS)
    kept = dedup_keep_first(union, ["text"], ["source_rank", row_id, "final_label"])
    return kept.select("text", "final_label", "source")


def unprocessed(new: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among those already processed."""
    return new.join(done.select(key), key, "left_anti")


def run_summary(df: DataFrame, done: DataFrame, key: str, category: str = "PENIPUAN") -> DataFrame:
    """Totals of a reading run: all, ok, skipped (done before), of one category."""
    mark = done.select(key).distinct().withColumn("_done", F.lit(True))
    kind = F.coalesce("kategori", F.lit(""))
    fresh = F.col("_done").isNull()
    return df.join(mark, key, "left").agg(
        F.count("*").alias("n_total"),
        F.count_if(fresh & (kind != "ERROR")).alias("n_ok"),
        F.count_if(~fresh).alias("n_skipped"),
        F.count_if(F.upper(kind) == category).alias("n_category"),
    )


# --- augmentation -----------------------------------------------------------


def expand_templates(
    spark: SparkSession,
    n: int = fv.SYNTHETIC_ROWS_PER_CLASS,
    seed: int = 42,
    scam_templates: Sequence[str] = fv.SCAM_TEMPLATES,
    neutral_templates: Sequence[str] = fv.NEUTRAL_TEMPLATES,
) -> DataFrame:
    """``n`` scam and ``n`` neutral rows from templates with seeded picks."""
    rows = spark.range(2 * n).withColumn("_scam", F.col("id") < n)

    def number(slot: str) -> Column:
        digest = seeded_hash(F.concat("id", F.lit(f":{slot}")), seed)
        return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")

    def pick(values: Sequence[str], slot: str, shift=0) -> Column:
        options = F.array(*[F.lit(v) for v in values])
        return F.get(options, ((number(slot) + shift) % len(values)).cast("int"))

    def digits(slot: str, count: int) -> Column:
        return F.lpad((number(slot) % 10**count).cast("string"), count, "0")

    first = number("nama1") % len(fv.NAMES)
    # The second name is a step of 1..len-1 further, so it always differs.
    step = number("nama2") % (len(fv.NAMES) - 1) + 1
    names = F.array(*[F.lit(v) for v in fv.NAMES])
    slots = {
        "bank": pick(fv.BANKS, "bank"),
        "nominal": pick(fv.NOMINALS, "nominal"),
        "nama1": F.get(names, first.cast("int")),
        "nama2": F.get(names, ((first + step) % len(fv.NAMES)).cast("int")),
        "rekening": digits("rekening", 10),
        "no_hp": F.concat(F.lit("08"), digits("no_hp", 9)),
        "link": pick(fv.LINKS, "link"),
        "item": pick(fv.ITEMS, "item"),
        "brand": pick(fv.BRANDS, "brand"),
    }
    text = F.when(F.col("_scam"), pick(scam_templates, "template")).otherwise(
        pick(neutral_templates, "template")
    )
    for name, value in slots.items():
        text = F.replace(text, F.lit("{" + name + "}"), value)
    return rows.select(
        text.alias("text"),
        F.when(F.col("_scam"), F.lit("Penipuan")).otherwise(F.lit("Netral")).alias("label_raw"),
        F.when(F.col("_scam"), F.lit("synthetic_scam"))
        .otherwise(F.lit("synthetic_neutral"))
        .alias("source"),
    )
