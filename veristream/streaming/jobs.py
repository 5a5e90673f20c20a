"""The long-running jobs: enrichment, feed loading, deduplication, aggregates.

Every job takes ``trigger``, e.g. ``{"processingTime": "60 seconds"}`` for a
polling job or ``{"availableNow": True}`` to work off what is there and stop.
All state is in the checkpoint, so a job restarted after a loss goes on where
it was.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from veristream import schemas
from veristream.operators import enrich as en, feed, similarity
from veristream.operators.feedback import codes
from veristream.plans.verdict import verdict
from veristream.sources import readers, topics

NOW = {"availableNow": True}


# --- enrichment -------------------------------------------------------------


def enrich(messages: DataFrame, scorer: Callable[[DataFrame], DataFrame] = verdict) -> DataFrame:
    """(topic, value) to analysed envelopes.  Narrow: no shuffle, no state."""
    cleaned = en.usable(en.clean_messages(messages))
    return en.envelope(en.with_verdict(cleaned, scorer))


def split_bad(messages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(messages with a text, dead letters with a reason)."""
    cleaned = en.clean_messages(messages)
    return en.usable(cleaned), en.dead_letters(cleaned)


def run_enrich(
    messages: DataFrame, topic: str, checkpoint: str, scorer=verdict, index: similarity.Index | None = None, **carrier
):
    """Publish analysed envelopes on the output topic.

    With an ``index`` of verified hoaxes the analysis tells the ``reason``: a look-up batch by
    batch, without state, in which the index stays where it is.  A folder's batch that is
    replayed replaces its first try.
    """
    if index is not None:

        def step(batch: DataFrame, batch_id: int) -> None:
            rows = similarity.with_reason(en.usable(en.clean_messages(batch)), index)
            topics.write_batch(en.envelope_json(en.envelope(en.with_verdict(rows, scorer))), topic, batch_id, **_place(carrier))

        return (
            messages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
            .trigger(**(carrier.get("trigger") or NOW)).start()
        )
    return topics.write_topic(
        en.envelope_json(enrich(messages, scorer)), topic, checkpoint, **carrier
    )


def _place(carrier: dict) -> dict:
    return {k: v for k, v in carrier.items() if k != "trigger"}


def run_dead_letters(messages: DataFrame, topic: str, checkpoint: str, **carrier):
    """Publish messages that cannot be analysed, with the reason."""
    _, bad = split_bad(messages)
    return topics.write_topic(topics.to_messages(bad), topic, checkpoint, **carrier)


# --- feed -------------------------------------------------------------------


def load_feed(envelopes: DataFrame, table: str, checkpoint: str, trigger=NOW):
    """Keep loading analysed messages into the feed table, first write wins.

    A batch that is replayed after a failure inserts only what is missing.  Of equal ids in
    a batch the first to arrive wins: by the carrier's time, partition and offset where the
    messages have them, else by their order in the files.
    """

    def insert(batch: DataFrame, _id: int) -> None:
        known = [c for c in ("timestamp", "topic", "partition", "offset") if c in batch.columns]
        arrival = [f"_arrived_{c}" for c in known] + ["_arrived_row"]
        marked = batch.withColumnsRenamed(dict(zip(known, arrival))).withColumn("_arrived_row", F.monotonically_increasing_id())
        # Used twice by the insert: its rows, and its ids against the table.
        rows = feed.flatten(en.parse_envelope(marked, keep=arrival), keep=arrival).persist()
        try:
            feed.insert_ignore(rows, table, [F.col(c) for c in arrival])
        finally:
            rows.unpersist()

    return (
        envelopes.writeStream.foreachBatch(insert)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


# --- deduplication and aggregates -------------------------------------------


def dedup(df: DataFrame, key: str, ts: str, delay: str = "1 day") -> DataFrame:
    """First row per key; keys are remembered for ``delay`` of event time."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def hourly(df: DataFrame, ts: str = "ts", delay: str = "10 minutes") -> DataFrame:
    """Messages and risky messages per hour of event time."""
    return (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, "1 hour").alias("w"))
        .agg(
            F.count("*").alias("n_messages"),
            F.count_if(F.col("label").isin("Hoaks", "Penipuan")).alias("n_risk"),
        )
        .select(F.col("w.start").alias("hour_start"), F.col("w.end").alias("hour_end"), "n_messages", "n_risk")
    )


def link_surge(
    df: DataFrame, link: str = "link", channel: str = "channel", ts: str = "ts",
    width: str = "30 minutes", slide: str = "5 minutes", delay: str = "10 minutes",
) -> DataFrame:
    """Per sliding window and link: uses, and channels it was seen in (estimate)."""
    return (
        df.withWatermark(ts, delay)
        .groupBy(F.window(ts, width, slide).alias("w"), link)
        .agg(F.count("*").alias("n_uses"), F.approx_count_distinct(channel).alias("n_channels"))
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), link, "n_uses", "n_channels")
    )


# --- feedback ---------------------------------------------------------------


def feedback_trigger(feedback: DataFrame, n: int, retrain: Callable[[], object], pool: str, checkpoint: str, trigger=NOW):
    """Collect corrections in ``pool``; retrain when ``n`` new ones have come.

    The count of rows not yet trained on is kept as files: a batch is stored
    under its number (so a replay replaces it) until a training uses it.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = codes(batch).withColumn("batch", F.lit(batch_id).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{pool}/rows")
        stored = spark.read.schema(schemas.STORED_FEEDBACK).parquet(f"{pool}/rows")
        trained = readers.first_existing(spark, [f"{pool}/trained"], schemas.TRAINED_BATCH)
        since = trained.agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]
        if stored.filter((F.col("batch") > since) & (F.col("batch") <= batch_id)).count() >= n:
            retrain()
            spark.range(1).select(F.lit(batch_id).cast("bigint").alias("batch")).write.mode(
                "append"
            ).parquet(f"{pool}/trained")

    return (
        feedback.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, trigger=NOW, mode: str = "append"):
    """Append a stream to a Parquet folder."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(**trigger)
        .start()
    )


def feedback_lines(spark, folder: str) -> DataFrame:
    """A stream of corrections from JSON-lines files."""
    return spark.readStream.schema(schemas.FEEDBACK_LOG).json(folder)
