"""The live feed: flat rows from envelopes, keyed inserts, and feed queries."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from veristream import fixed_values as fv, schemas
from veristream.functions import labels, text as tx, times
from veristream.sources import files


def source_type(topic: Column) -> Column:
    """Kind of channel by the name of the topic."""
    t = F.lower(topic)
    return (
        F.when(F.contains(t, F.lit("telegram")), F.lit("Telegram"))
        .when(F.contains(t, F.lit("twitter")), F.lit("Twitter"))
        .otherwise(F.lit("RSS"))
    )


def snippet(kind: Column, title: Column, description: Column, message: Column, text: Column) -> Column:
    """RSS: 'title - description' or the one that is filled; else the message."""
    head = tx.non_empty(tx.strip(title))
    rest = tx.non_empty(tx.strip(description))
    rss = F.coalesce(F.concat_ws(" - ", head, rest), F.lit(""))
    other = tx.first_non_empty(message, text, description)
    return tx.ellipsis(F.when(kind == "RSS", rss).otherwise(other), 150, 147)


def flatten(envelopes: DataFrame, keep: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """Envelopes to ``live_feed`` rows.

    Times of news and chat records and the channel name of chats are used where
    the generic fields are absent; ``strict=True`` looks at the generic fields
    only.  All times become ISO text in UTC, so that they sort; what cannot be
    parsed stays as it is.  Rows without an id get one from their content, source
    and sender, so a replay of the same message gives the same id, and the same
    words in two channels or from two senders are two rows.
    """
    rows = envelopes.withColumn("_o", F.from_json("original_data", schemas.ORIGINAL))
    o = lambda name: F.col(f"_o.{name}")
    time_fields = ["timestamp", "tweeted_at", "date", "pubDate"]
    source_fields = [o("source")]
    if not strict:
        time_fields += ["published_at", "sent_at"]
        source_fields.append(o("channel_name"))
    rows = rows.select(
        *keep,
        "source_topic",
        "analysis",
        times.sortable(tx.first_non_empty(*[o(f) for f in time_fields])).alias("timestamp"),
        F.coalesce(*source_fields, F.col("source_topic")).alias("source"),
        source_type(F.col("source_topic")).alias("source_type"),
        tx.first_non_empty(o("link"), o("url")).alias("url"),
        "_o",
    )
    content_id = F.sha2(
        F.concat_ws(
            "\x1f",
            "source_topic",
            tx.first_non_empty(
                F.col("url"), o("message"), o("text"), o("description"), o("title")
            ),
            "timestamp",
            F.coalesce("source", F.lit("")),
            F.coalesce(o("sender_id"), o("username"), F.lit("")),
        ),
        256,
    )
    return rows.select(
        *keep,
        # The last value makes the id non-null for the planner too; else every join on
        # it would bring an "is not null" filter that parses the JSON once more per field.
        F.coalesce(
            tx.non_empty(o("id")), tx.non_empty(o("tweet_id")), content_id, F.lit("")
        ).alias("id"),
        "timestamp",
        "source",
        "source_type",
        snippet(
            F.col("source_type"), o("title"), o("description"), o("message"), o("text")
        ).alias("text_snippet"),
        F.coalesce("analysis.label", F.lit("Valid")).alias("label"),
        F.coalesce("analysis.score", F.lit(0.0)).alias("confidence"),
        F.coalesce(
            tx.non_empty(F.col("analysis.category")), tx.non_empty(o("category")), F.lit("umum")
        ).alias("topic"),
        "url",
    )


# --- table ------------------------------------------------------------------


#: Each file tells, by a Bloom filter for each run of rows, which ids it cannot hold.
BLOOM = {
    "parquet.bloom.filter.enabled#id": "true",
    "parquet.bloom.filter.expected.ndv#id": "100000",
    "parquet.bloom.filter.adaptive.enabled": "true",
}
#: Ids of a batch up to which they are looked up one by one in those filters.
LOOKED_UP = 1000


def ensure_table(spark: SparkSession, name: str, path: str | None = None) -> None:
    """Create the feed table if it is not there."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas.LIVE_FEED)
    location = f" LOCATION '{path}'" if path else ""
    options = ", ".join(f"'{k}' '{v}'" for k, v in BLOOM.items())
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS ({options}){location}")


def seen_ids(batch: DataFrame, table: DataFrame) -> DataFrame:
    """Ids of the batch that the table holds.

    Only the table's id column is read.  A small batch's ids go into the scan as a condition, and
    runs of rows whose Bloom filter rules all of them out are not read; a larger one's are joined.
    The batch is computed once more for that, so it had better be persisted.
    """
    ids = batch.select("id").filter(F.col("id").isNotNull()).distinct()
    few = [row["id"] for row in ids.limit(LOOKED_UP + 1).collect()]
    if len(few) <= LOOKED_UP:
        return table.select("id").filter(F.col("id").isin(few))
    return _joined_ids(batch, table)


def _joined_ids(batch: DataFrame, table: DataFrame) -> DataFrame:
    """The semi join turns into a broadcast of the batch's ids while they are few, so a big table is not shuffled."""
    return table.select("id").join(batch.select("id").distinct(), "id", "left_semi")


def new_rows(batch: DataFrame, table: DataFrame, order: Sequence[Column] = (), seen: DataFrame | None = None) -> DataFrame:
    """Rows of the batch whose id is new; of equal ids the first one wins.

    ``seen``: the batch's ids that the table holds, where they are known already.
    """
    first = Window.partitionBy("id").orderBy(*(order or [F.col("timestamp"), F.col("text_snippet")]))
    unique = batch.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank")
    return unique.join(_joined_ids(batch, table) if seen is None else seen, "id", "left_anti")


def insert_ignore(batch: DataFrame, table: str, order: Sequence[Column] = ()) -> None:
    """Append the batch's new ids to the feed table; known ids are left alone.

    ``order`` decides between rows of the batch that share an id: the first to arrive.
    """
    spark = batch.sparkSession
    sweep(spark, table)
    stored = spark.table(table)
    fresh = new_rows(batch, stored, order, seen_ids(batch, stored))
    if "inserted_at" not in fresh.columns:
        fresh = fresh.withColumn("inserted_at", F.current_timestamp())
    fresh.select(*schemas.LIVE_FEED.names).write.insertInto(table)


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """The rows that stay.  Rows for which the predicate is null stay."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


#: Table property: the folder that the table was in before, whose late files are still to be taken over.
BEFORE = "veristream.before"
TAKEN = "_taken"  # beside the new files, hidden from readers: the old ones that they were made of


def _location(spark: SparkSession, table: str) -> str:
    details = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    return next(row["data_type"] for row in details if row["col_name"] == "Location").rstrip("/")


def _take(spark: SparkSession, path: str, names: Sequence[str]) -> None:
    spark.createDataFrame([(n,) for n in names], "file string").write.mode("append").parquet(f"{path}/{TAKEN}")


def sweep(spark: SparkSession, table: str) -> int:
    """Take over rows that a writer put in the table's former folder while the table moved; number of files.

    Called before each insertion and each change, so that such rows are late but never lost.
    """
    properties = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    before = properties.get(BEFORE)
    if not before:
        return 0
    here = _location(spark, table)
    taken = {r["file"] for r in spark.read.parquet(f"{here}/{TAKEN}").collect()}
    late = [f for f in files.leaves(spark, before) if f not in taken]
    if late:
        _take(spark, here, late)
        spark.read.schema(schemas.LIVE_FEED).parquet(*late).write.insertInto(table)
    return len(late)


def _swap(spark: SparkSession, table: str, change: Callable[[DataFrame], tuple[DataFrame, Column]]) -> int:
    """Write the changed rows beside the old files, then point the table there; number of rows affected.

    ``change`` gives the rows that stay and, of the rows before, a condition for those affected.
    The files to change are listed once; files that appear meanwhile are changed in a further
    round, until there are none.  Readers see the old or the new state, never a mixture.
    """
    sweep(spark, table)
    old = _location(spark, table)
    path = f"{re.sub('[.]v-[0-9a-f]+$', '', old)}.v-{uuid.uuid4().hex}"
    spark.createDataFrame([], schemas.LIVE_FEED).write.options(**BLOOM).parquet(path)
    _take(spark, path, [])
    taken: set[str] = set()
    affected = 0
    while fresh := [f for f in files.leaves(spark, old) if f not in taken]:
        observed = Observation()
        rows = spark.read.schema(schemas.LIVE_FEED).parquet(*fresh)
        _, hit = change(rows)
        stay, _ = change(rows.observe(observed, F.count_if(hit).alias("affected")))
        stay.select(*schemas.LIVE_FEED.names).write.options(**BLOOM).mode("append").parquet(path)
        affected += int(observed.get["affected"] or 0)
        _take(spark, path, fresh)
        taken.update(fresh)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BEFORE}' = '{old}')")
    spark.catalog.refreshTable(table)
    sweep(spark, table)  # what came between the last look and the change of place
    return affected


def purge(spark: SparkSession, table: str, predicate: Column) -> int:
    """Delete rows of the feed table; gives the number of rows deleted."""
    hit = F.coalesce(predicate, F.lit(False))
    return _swap(spark, table, lambda rows: (rows.filter(~hit), hit))


def recleaned(c: Column) -> Column:
    has_tags = F.contains(c, F.lit("<")) & F.contains(c, F.lit(">"))
    return F.when(has_tags, tx.html_to_text(c)).otherwise(c)


def reclean(df: DataFrame, column: str = "text_snippet") -> DataFrame:
    """Clean stored texts that hold tags; ``changed`` tells which rows differ."""
    c = F.col(column)
    return df.withColumn("_clean", recleaned(c)).withColumns(
        {"changed": F.coalesce(F.col("_clean") != c, F.lit(False)), column: F.col("_clean")}
    ).drop("_clean")


def reclean_table(spark: SparkSession, table: str) -> int:
    """Clean the stored snippets of the feed table; number of rows changed."""
    c = F.col("text_snippet")
    return _swap(spark, table, lambda rows: (reclean(rows).drop("changed"), F.coalesce(recleaned(c) != c, F.lit(False))))


# --- queries ----------------------------------------------------------------


def latest(df: DataFrame, n: int = 25) -> DataFrame:
    """Newest ``n`` rows, 1 to 100."""
    if not 1 <= n <= 100:
        raise ValueError("n must be from 1 to 100")
    return df.orderBy(F.col("timestamp").desc(), F.col("id")).limit(n)


def search(df: DataFrame, query: str, columns: Sequence[str]) -> DataFrame:
    """Rows whose joined columns hold the query; a blank query keeps all."""
    wanted = query.strip().lower()
    if not wanted:
        return df
    joined = F.concat_ws(" ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return df.filter(F.contains(F.lower(joined), F.lit(wanted)))


def alerts(df: DataFrame, min_score: float) -> DataFrame:
    """Risky rows with at least this confidence."""
    return df.filter(labels.is_risk(F.col("label")) & (F.col("confidence") >= min_score))


def display(df: DataFrame) -> DataFrame:
    """Feed rows as the dashboard shows them."""
    shown = F.initcap(F.lower(F.coalesce("label", F.lit(""))))
    clock = F.date_format(times.parse_time(F.col("timestamp")), "HH:mm:ss")
    return df.select(
        "id",
        F.coalesce(clock, F.lit("-")).alias("time"),
        F.coalesce(
            tx.non_empty(F.col("source")), tx.non_empty(F.col("source_type")), F.lit("Unknown")
        ).alias("source"),
        F.coalesce("text_snippet", F.lit("")).alias("snippet"),
        F.when(shown.isin(fv.LABELS), shown).otherwise(F.lit("Review")).alias("status"),
        F.round(F.coalesce("confidence", F.lit(0.0))).cast("int").alias("confidence"),
        "url",
    )
