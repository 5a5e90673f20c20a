"""Topics: message streams by topic name.

Two carriers with one row shape (topic, value, timestamp): Kafka, and a folder
per topic with text files of one JSON value per line.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from veristream import fixed_values as fv
from veristream.sources import files


def _from_kafka(reader, topics, starting, bootstrap):
    raw = (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", ",".join(topics))
        .option("startingOffsets", starting)
        .load()
    )
    return raw.select(
        "topic", F.col("value").cast("string").alias("value"), "partition", "offset", "timestamp"
    )


def read_topics(
    spark: SparkSession,
    topics: Sequence[str] = tuple(fv.INPUT_TOPICS),
    starting: str = "latest",
    bootstrap: str | None = None,
    folder: str | None = None,
    files_per_trigger: int | None = None,
    handover: str | None = None,
) -> DataFrame:
    """A stream of (topic, value, timestamp, ...) from Kafka or from a folder.

    ``starting="earliest"`` gives history first, then live messages.  For a folder, "latest" leaves
    out the files that were there at the first start, which are written down at ``handover``;
    without a place for that a folder is read from its beginning.
    """
    if bootstrap:
        return _from_kafka(spark.readStream, topics, starting, bootstrap)
    if starting == "latest" and handover:
        return history_then_live(spark, handover, topics, folder=folder, files_per_trigger=files_per_trigger)[1]
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return _from_folder(reader.load(folder), topics)


def _from_folder(lines: DataFrame, topics) -> DataFrame:
    parts = F.split("_metadata.file_path", "/")
    above = F.element_at(parts, -2)
    return lines.select(
        # Files of a numbered batch lie one folder deeper.
        F.when(F.startswith(above, F.lit("batch=")), F.element_at(parts, -3)).otherwise(above).alias("topic"),
        "value",
        F.col("_metadata.file_modification_time").alias("timestamp"),
    ).filter(F.col("topic").isin(list(topics)))


def read_topics_bounded(
    spark: SparkSession, topics: Sequence[str] = tuple(fv.INPUT_TOPICS), bootstrap: str | None = None, folder: str | None = None
) -> DataFrame:
    """All messages from the earliest to the last one present, as a batch."""
    if bootstrap:
        return _from_kafka(spark.read, topics, "earliest", bootstrap)
    lines = spark.read.format("text").option("recursiveFileLookup", True).load(folder)
    return _from_folder(lines, topics)


def history_then_live(
    spark: SparkSession, handover: str, topics: Sequence[str] = tuple(fv.INPUT_TOPICS), bootstrap: str | None = None,
    folder: str | None = None, files_per_trigger: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(all messages there are now, a stream of those that come after), without a gap or a repetition.

    Where the history ends is written to ``handover`` by the first call (a folder's files, a
    broker's offsets) and read by later ones, so a restarted job gets the same two parts.
    """
    if bootstrap:
        if not files.exists(spark, f"{handover}/*.parquet"):
            now = _from_kafka(spark.read, topics, "earliest", bootstrap)
            ends = now.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next"))
            ends.write.mode("overwrite").parquet(handover)
        offsets: dict[str, dict[str, int]] = {}
        for row in spark.read.parquet(handover).collect():
            offsets.setdefault(row["topic"], {})[str(row["partition"])] = row["next"]
        ends = spark.read.parquet(handover)
        before = _from_kafka(spark.read, topics, "earliest", bootstrap).join(F.broadcast(ends), ["topic", "partition"])
        return before.filter(F.col("offset") < F.col("next")).drop("next"), _from_kafka(
            spark.readStream, topics, json.dumps(offsets) if offsets else "earliest", bootstrap
        )
    if not files.exists(spark, f"{handover}/*.parquet"):
        found = files.leaves(spark, folder)
        spark.createDataFrame([(f,) for f in found], "path string").coalesce(1).write.mode("overwrite").parquet(handover)
    listed = [row["path"] for row in spark.read.parquet(handover).collect()]
    lines = spark.read.format("text").load(listed) if listed else spark.createDataFrame([], "value string").select(
        "value", F.struct(F.lit("").alias("file_path"), F.current_timestamp().alias("file_modification_time")).alias("_metadata")
    )
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    place = lambda c: F.regexp_replace(c, "^file:/+", "/")  # listings and rows may differ in the slashes
    old = spark.createDataFrame([(f,) for f in listed], "path string").select(place(F.col("path")).alias("_old"))
    live = reader.load(folder).select("value", "_metadata", place(F.col("_metadata.file_path")).alias("_path"))
    fresh = live.join(F.broadcast(old), F.col("_path") == F.url_decode(F.col("_old")), "left_anti").drop("_path")
    return _from_folder(lines, topics), _from_folder(fresh, topics)


def topic_summary(df: DataFrame, order: Sequence[str] = ("partition", "offset")) -> DataFrame:
    """Number of messages and the last message."""
    return df.agg(
        F.count("*").alias("n_messages"), F.max_by("value", F.struct(*order)).alias("last_value")
    )


def to_messages(df: DataFrame, *skip: str) -> DataFrame:
    """Each row as one JSON ``value``."""
    columns = [c for c in df.columns if c not in skip]
    return df.select(*skip, F.to_json(F.struct(*columns)).alias("value"))


def write_batch(df: DataFrame, topic: str, batch_id: int, bootstrap=None, folder=None) -> None:
    """Publish one numbered batch of ``value`` rows; in a folder a replay takes the first try's place."""
    rows = df.select("value")
    if bootstrap:
        rows.write.format("kafka").option("kafka.bootstrap.servers", bootstrap).option("kafka.acks", "all").option(
            "kafka.retries", "5"
        ).option("topic", topic).save()
    else:
        rows.write.mode("overwrite").text(f"{folder}/{topic}/batch={batch_id}")


def write_topic(df: DataFrame, topic: str, checkpoint: str, bootstrap=None, folder=None, trigger=None):
    """Publish a stream of ``value`` rows; all replicas must confirm, 5 retries.

    With ``folder`` the values go to text files under ``folder/topic``.
    """
    writer = df.select("value").writeStream.option("checkpointLocation", checkpoint)
    writer = writer.trigger(**(trigger or {"availableNow": True}))
    if bootstrap:
        return (
            writer.format("kafka")
            .option("kafka.bootstrap.servers", bootstrap)
            .option("kafka.acks", "all")
            .option("kafka.retries", "5")
            .option("topic", topic)
            .start()
        )
    return writer.format("text").option("path", f"{folder}/{topic}").start()
