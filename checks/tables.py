"""The given tables in the roles of the pipeline's records.

``checks/oracle.py`` says the same in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from veristream.functions import scoring

ZERO_TIME = "2024-01-01T00:00:00Z"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _case(column, mapping, default=None):
    out = None
    for key, value in mapping.items():
        out = (F if out is None else out).when(column == key, F.lit(value))
    return out.otherwise(F.lit(default))


EVENT_LABELS = {
    "error": "Penipuan", "click": "Hoaks", "view": "Valid", "purchase": "Netral",
    "signup": "Review",
}


def live_feed(spark: SparkSession, sf: str) -> DataFrame:
    """events as feed rows; some without a time or a source name."""
    e = table(spark, sf, "events")
    return e.select(
        F.col("event_id").cast("string").alias("id"),
        F.when(F.col("user_id") % 50 == 0, F.lit(""))
        .otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .alias("timestamp"),
        F.when(F.col("user_id") % 20 == 7, F.lit(""))
        .otherwise(F.concat(F.lit("user_"), (F.col("user_id") % 20).cast("string")))
        .alias("source"),
        _case(F.col("user_id") % 3, {0: "RSS", 1: "Telegram"}, "Twitter").alias("source_type"),
        F.concat("event_type", F.lit(" "), "props").alias("text_snippet"),
        _case(F.col("event_type"), EVENT_LABELS).alias("label"),
        F.least(F.col("value") / 5, F.lit(100.0)).alias("confidence"),
        F.get_json_object("props", "$.k").alias("topic"),
        F.concat(F.lit("http://example.com/"), F.col("event_id").cast("string")).alias("url"),
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """events as JSON messages of all shapes, broken ones among them."""
    e = table(spark, sf, "events")
    k = F.col("event_id").cast("string")
    kind = F.col("event_id") % 7
    j = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    value = (
        F.when(kind == 0, j('{"message":"<b>m</b>  ', k, '","title":"t"}'))
        .when(kind == 1, j('{"title":"t ', k, '","description":""}'))
        .when(kind == 2, j('{"text":"x ', F.col("event_type"), '","message":"m"}'))
        .when(kind == 3, j('{"text":null,"message":"m ', k, '"}'))
        .when(kind == 4, j("oops ", k))
        .when(kind == 5, j('{"title":"  a\\n', k, ' <i>b</i>"}'))
        .otherwise(j('{"description":', k, "}"))
    )
    return e.select(
        "event_id",
        _case(
            F.col("user_id") % 3, {0: "rss-news", 1: "telegram-messages"}, "twitter-tweets"
        ).alias("topic"),
        value.alias("value"),
        "ts",
    )


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """events as analysed envelopes of the three topics."""
    e = table(spark, sf, "events")
    k = F.col("event_id").cast("string")
    kind = F.col("user_id") % 3
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    j = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    # One in four news times as feeds give them, with a zone.
    local = F.date_format(F.col("ts") + F.expr("INTERVAL 7 HOURS"), "EEE, dd MMM yyyy HH:mm:ss")
    published = F.when(F.col("event_id") % 4 == 0, F.concat(local, F.lit(" +0700"))).otherwise(iso)
    original = (
        F.when(
            kind == 0,
            j('{"source":"src', (F.col("event_id") % 9).cast("string"), '","title":" T ', k,
              ' ","description":"', F.repeat(F.concat(F.col("event_type"), F.lit(" ")), (F.col("event_id") % 40).cast("int")),
              '","link":"http://e.com/', k, '","published_at":"', published, '"}'),
        )
        .when(
            kind == 1,
            j('{"sender_id":"u', (F.col("user_id") % 50).cast("string"), '","channel_name":"ch', (F.col("event_id") % 4).cast("string"), '","message":"hello ', k,
              '","sent_at":"', iso, '"}'),
        )
        .otherwise(
            j('{"tweet_id":"tw_', (F.col("event_id") - F.col("event_id") % 6).cast("string"), '","text":"', F.col("event_type"), " ", k,
              '","category":"social_media","tweeted_at":"', iso, '","url":""}')
        )
    )
    return e.select(
        "event_id",
        original.alias("original_data"),
        _case(kind, {0: "rss-news", 1: "telegram-messages"}, "twitter-tweets").alias("source_topic"),
        F.struct(
            (F.col("value") / 5).alias("score"),
            _case(F.col("event_type"), EVENT_LABELS).alias("label"),
            F.when(F.col("event_id") % 5 == 0, F.lit("politik")).otherwise(F.lit("")).alias("category"),
        ).alias("analysis"),
    )


def labeled(spark: SparkSession, sf: str) -> DataFrame:
    """labels and documents as labelled texts."""
    good, bad = F.col("quality") == 1, F.col("toxic") == 1
    label = (
        F.when(good & ~bad, F.lit("Valid"))
        .when(~good & ~bad, F.lit("Netral"))
        .when(good & bad, F.lit("Hoaks"))
        .otherwise(F.lit("Penipuan"))
    )
    return table(spark, sf, "labels").join(table(spark, sf, "documents"), "doc_id").select(
        "doc_id", "text", label.alias("final_label"), "source"
    )


def numbers(key: str, a: int, b: int, c: int, d: int):
    part = lambda m: (F.col(key) * m % 1000) / 10.0
    return scoring.scores(part(a), part(b), part(c), part(d))


def base_scores(df: DataFrame) -> DataFrame:
    return df.withColumn("base", numbers("doc_id", 37, 53, 71, 97))


def deep_scores(spark: SparkSession, sf: str) -> DataFrame:
    """embeddings as the table of an outside model's scores."""
    e = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"))
    return e.withColumn("deep", numbers("doc_id", 41, 59, 73, 89))


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """customer as the registry of scam identifiers."""
    key = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        F.concat(F.lit("scam-"), key.cast("string")).alias("id"),
        _case(key % 2, {0: "bank_account"}, "phone_number").alias("identifier_type"),
        F.when(key % 11 == 0, F.lit("1234")).otherwise(F.col("c_name")).alias("identifier_value"),
        F.when(key % 13 == 0, F.lit("")).otherwise(F.col("c_mktsegment")).alias("owner_name"),
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("source"),
        (key % 7 - F.when(key % 17 == 0, 7).otherwise(0)).cast("int").alias("report_count"),
        _case(key % 4, {0: "active", 1: "under_review", 2: "resolved"}, "Aktif").alias("status"),
        F.lit(None).cast("string").alias("notes"),
        F.concat(F.lit("2024-01-01T00:00:"), F.lpad((key % 60).cast("string"), 2, "0"), F.lit("Z")).alias("created_at"),
        F.lit(ZERO_TIME).alias("updated_at"),
    )


def registry_changes(spark: SparkSession, sf: str) -> DataFrame:
    """orders as changes of the registry, some of unknown ids."""
    key = F.col("o_orderkey")
    words = lambda *w: F.array(*[F.lit(x) for x in w])
    return table(spark, sf, "orders").select(
        _case(key % 7, {0: "create", 1: "delete"}, "update").alias("op"),
        F.concat(
            F.lit("scam-"),
            F.when(key % 10 == 0, F.lit("new-")).otherwise(F.lit("")),
            F.col("o_custkey").cast("string"),
        ).alias("id"),
        key.alias("seq"),
        F.when(key % 3 == 0, words("status", "report_count"))
        .when(key % 3 == 1, words("notes"))
        .otherwise(words("owner_name", "notes"))
        .alias("set_fields"),
        F.struct(
            F.lit("bank_account").alias("identifier_type"),
            F.concat(F.lit("acc"), key.cast("string")).alias("identifier_value"),
            F.concat(F.lit("own"), key.cast("string")).alias("owner_name"),
            F.col("o_orderpriority").alias("source"),
            (key % 90).cast("int").alias("report_count"),
            F.when(F.col("o_orderstatus") == "F", F.lit("resolved")).otherwise(F.lit("under_review")).alias("status"),
            F.when(key % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("n"), key.cast("string"))).alias("notes"),
        ).alias("row"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("at"),
    )


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """benchmark as the verified hoaxes."""
    return table(spark, sf, "benchmark").select(
        F.col("item_id").alias("id"),
        F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("title"),
        F.col("text").alias("body_text"),
    )


def silver_sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """documents, conversations and benchmark as the six raw sources."""
    d = table(spark, sf, "documents")
    c = table(spark, sf, "conversations")
    row = F.col("doc_id").alias("row_id")
    return {
        "sms": c.select(
            F.col("text").alias("Teks"), (F.col("turn") % 4).cast("int").alias("label"),
            F.lit("sms").alias("source"), (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"),
        ),
        "kaggle": d.filter(F.col("doc_id") % 5 == 0).select(
            F.when(F.col("doc_id") % 2 == 0, F.col("text")).alias("text_new"),
            F.col("text").alias("FullText"),
            _case(F.col("doc_id") % 3, {0: "1.0", 1: "0"}, "nan").alias("hoax"),
            F.lit("kaggle").alias("source"), row,
        ),
        "synthetic": d.filter(F.col("doc_id") % 5 == 1).select(
            "text", F.lit("Netral").alias("label_raw"), F.lit("synthetic").alias("source"), row
        ),
        "komdigi": table(spark, sf, "benchmark").select(
            F.concat(F.lit("item "), F.col("item_id").cast("string")).alias("title"),
            F.col("text").alias("body_text"), F.lit("komdigi").alias("source"), F.col("item_id").alias("row_id"),
        ),
        "vijayandika": d.filter(F.col("doc_id") % 5 == 2).select(
            F.col("text").alias("Narasi"), F.lit("vijayandika").alias("source"), row
        ),
        "ocr": d.filter(F.col("doc_id") % 5 > 2).select(
            "text", F.lit("Penipuan").alias("final_label"), F.lit("ocr").alias("source"), row
        ),
    }
