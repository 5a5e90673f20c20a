"""User corrections: parse, add to the training data, pool and archive."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from veristream import schemas
from veristream.functions import labels, text as tx
from veristream.operators import train
from veristream.operators.curate import dedup_keep_first
from veristream.session import materialize
from veristream.sources import files, readers


def codes(feedback: DataFrame) -> DataFrame:
    """(text, correct_label) to (text, label_num); unknown labels are dropped."""
    return (
        feedback.withColumn("label_num", labels.feedback_code(F.col("correct_label")))
        .filter(F.col("label_num").isNotNull() & F.col("text").isNotNull())
        .withColumn("text", tx.clean_train(F.col("text")))
        .drop("correct_label")
    )


def _first_per_text(parts: list[DataFrame], order: str) -> DataFrame:
    out = None
    for rank, part in enumerate(parts):
        row = F.col(order).cast("bigint") if order in part.columns else F.lit(0).cast("bigint")
        one = part.select("text", "label_num", F.lit(rank).alias("_part"), row.alias("_row"))
        out = one if out is None else out.unionByName(one)
    kept = dedup_keep_first(out, ["text"], ["_part", "_row", "label_num"])
    return kept.select("text", "label_num")


def training_set(original: DataFrame, new: DataFrame, order: str = "row_id") -> DataFrame:
    """Original labelled texts and corrections, one row per cleaned text."""
    cleaned = original.filter(F.col("text").isNotNull()).withColumns(
        {
            "text": tx.clean_train(F.col("text")),
            "label_num": labels.to_code(F.col("final_label")),
        }
    )
    return _first_per_text([cleaned, new], order)


def merge_pool(existing: DataFrame, new: DataFrame, order: str = "row_id") -> DataFrame:
    """The pool and new samples, first row per text."""
    return _first_per_text([existing, new], order)


@dataclass(frozen=True)
class Run:
    """One numbered retraining in the commit log: which files it claimed, and whether all of it is done.

    Everything that it writes bears its number and replaces what a try before it wrote, so a job
    that died anywhere is finished by the next call, neither losing nor repeating anything.
    """

    log: str
    number: int
    paths: tuple[str, ...]

    @property
    def folder(self) -> str:
        return f"{self.log}/run={self.number}"

    def done(self, spark: SparkSession) -> bool:
        return files.exists(spark, f"{self.folder}/done/*.parquet")


def _last(spark: SparkSession, log: str) -> Run | None:
    claims = files.expand(spark, f"{log}/run=*/claimed/*.parquet")
    if not claims:
        return None
    number = max(int(c.split("/run=")[-1].split("/")[0]) for c in claims)
    rows = spark.read.parquet(f"{log}/run={number}/claimed").collect()
    return Run(log, number, tuple(sorted(r["path"] for r in rows)))


def claim(spark: SparkSession, log: str, number: int, paths: list[str]) -> Run:
    """Write down which files a run is about, before anything is done with them."""
    run = Run(log, number, tuple(paths))
    spark.createDataFrame([(f,) for f in paths], "path string").coalesce(1).write.mode("overwrite").parquet(f"{run.folder}/claimed")
    return run


def corrections(spark: SparkSession, run: Run) -> DataFrame:
    """The run's cleaned corrections, one row per text; stored, as training and pool both want them."""
    cleaned = _corrections(spark, run.paths)
    return materialize(merge_pool(cleaned.limit(0), cleaned), "corrections")


def train_on(
    spark: SparkSession, run: Run, new: DataFrame, original: DataFrame, model_path: str,
    fit: Callable[[DataFrame], PipelineModel],
):
    rows = training_set(original, new).withColumnRenamed("text", "text_clean")
    model = fit(rows)
    train.save(model, model_path)
    return model


def add_to_pool(spark: SparkSession, run: Run, fresh: DataFrame, pool_path: str) -> None:
    """The run's texts that no earlier run has put in the pool."""
    if files.exists(spark, f"{pool_path}/*/*.parquet"):
        known = spark.read.parquet(pool_path).filter(F.col("run") < run.number)
        fresh = fresh.join(known.select("text"), "text", "left_anti")
    fresh.write.mode("overwrite").parquet(f"{pool_path}/run={run.number}")


def archive(spark: SparkSession, run: Run, archive_path: str) -> None:
    """The lines of the run's files, under its number."""
    spark.read.text(list(run.paths)).write.mode("overwrite").text(f"{archive_path}/run={run.number}")


def finish(spark: SparkSession, run: Run) -> None:
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{run.folder}/done")


def clear(spark: SparkSession, run: Run) -> None:
    """Delete the claimed files of a run that is done."""
    for file in run.paths:
        files.delete(spark, file)


def _corrections(spark: SparkSession, paths) -> DataFrame:
    good, _ = readers.read_jsonl(spark, list(paths), schemas.FEEDBACK_LOG)
    return codes(good)


def retrain(
    spark: SparkSession,
    feedback_path: str,
    original: DataFrame,
    model_path: str,
    pool_path: str,
    archive_path: str,
    at_least: int = 1,
    log_path: str | None = None,
    fit: Callable[[DataFrame], PipelineModel] | None = None,
):
    """The retraining job; gives the model, or None if there was too little.

    A run claims the files that are there, trains, adds to pool and archive, is marked as done, and
    deletes its files, in this order.  A run that was broken off is finished first, on the files it
    had claimed.  What arrives meanwhile waits for the next run.  Pool and archive are
    partitioned by ``run``; the log is beside the pool unless ``log_path`` says otherwise.
    """
    log = log_path or f"{pool_path.rstrip('/')}_runs"
    run = _last(spark, log)
    if run is not None and run.done(spark):
        clear(spark, run)  # it may have died before
    if run is None or run.done(spark):
        paths = files.leaves(spark, feedback_path)
        if not paths or len(_corrections(spark, paths).take(at_least)) < at_least:
            return None
        run = claim(spark, log, run.number + 1 if run else 1, paths)
    new = corrections(spark, run)
    model = train_on(spark, run, new, original, model_path, fit or train.fit)
    add_to_pool(spark, run, new, pool_path)
    archive(spark, run, archive_path)
    finish(spark, run)
    clear(spark, run)
    return model
