"""The lake build: bronze tables to silver to gold."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from veristream import fixed_values as fv, schemas
from veristream.operators import curate, sampling
from veristream.sources import files, readers, writers
from veristream.sources.lake import Lake

BRONZE = {name: f"{name}_data" for name in fv.SILVER_ORDER}


def build_bronze(spark: SparkSession, lake: Lake, raw: Mapping[str, DataFrame]) -> None:
    """Store the raw tables of those sources that there are."""
    for name, df in raw.items():
        lake.write(df, "bronze", BRONZE[name])


def raw_sources(spark: SparkSession, folder: str, n_synthetic: int = fv.SYNTHETIC_ROWS_PER_CLASS):
    """Raw tables from a folder of downloaded files; absent sources are left out."""
    out = {"synthetic": curate.expand_templates(spark, n_synthetic)}
    sms = f"{folder}/dataset_sms_spam_v1.csv"
    if files.exists(spark, sms):
        out["sms"] = readers.read_csv(spark, sms, schemas.SMS).withColumn("source", F.lit("sms_spam_v1"))
    for name, glob, prefix in [
        ("kaggle", f"{folder}/kaggle/Cleaned/*.csv", "kaggle_"),
        ("vijayandika", f"{folder}/kaggle/RAW/{{turnbackhoax,vijayandika*}}.csv", "vijayandika_"),
    ]:
        if files.exists(spark, glob):
            out[name] = readers.read_glob(spark, glob, "csv", prefix)
    komdigi = f"{folder}/komdigi/komdigi_hoaks_latest.csv"
    if files.exists(spark, komdigi):
        out["komdigi"] = readers.read_csv(spark, komdigi, schemas.HOAX_ARTICLE).withColumn(
            "source", F.lit("komdigi_api")
        )
    ocr = f"{folder}/ocr_results.json"
    if files.exists(spark, ocr):
        out["ocr"] = curate.ocr_rows(readers.read_json_array(spark, ocr, schemas.OCR_RESULT))
    return out


def build_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    present = {
        name: lake.read(spark, "bronze", table)
        for name, table in BRONZE.items()
        if lake.has(spark, "bronze", table)
    }
    return lake.write(curate.build_silver(present), "silver", "cleaned_dataset")


def build_gold(
    spark: SparkSession,
    lake: Lake,
    n: int = fv.GOLD_PER_CLASS,
    seed: int = 42,
    csv_path: str | None = None,
) -> DataFrame:
    silver = lake.read(spark, "silver", "cleaned_dataset", schemas.LABELED_TEXT)
    gold = sampling.shuffle(sampling.balance(silver, n, seed), seed)
    gold = lake.write(gold, "gold", "final_dataset_balanced")
    if csv_path:
        writers.export_csv(gold, csv_path, schemas.LABELED_TEXT.names)
    return gold
