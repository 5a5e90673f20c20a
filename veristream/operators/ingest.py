"""Raw items of every kind to their record contracts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from veristream import fixed_values as fv, schemas
from veristream.functions import text as tx
from veristream.functions.planning import compute_once, explode_rows
from veristream.functions.times import iso_z, now_z


def _now(now: Column | None) -> Column:
    return now_z() if now is None else now


def require(df: DataFrame, column: str) -> DataFrame:
    """Keep rows whose key is neither null nor empty."""
    return df.filter(F.coalesce(F.col(column), F.lit("")) != "")


def feed_registry(spark: SparkSession) -> DataFrame:
    """The fixed list of feeds: source, url, category."""
    return spark.createDataFrame(fv.FEEDS, "source string, url string, category string")


def attach_feed(df: DataFrame, feeds: DataFrame | None = None) -> DataFrame:
    """Add url and category of the row's ``source``.

    The built-in registry is a short constant and is broadcast; a registry
    passed in is joined as Spark sees fit for its size.
    """
    if feeds is None:
        feeds = F.broadcast(feed_registry(df.sparkSession))
    return df.join(feeds, "source", "left")


def normalize_rss(
    df: DataFrame, source: Column, category: Column, now: Column | None = None
) -> DataFrame:
    """Items (link, title, description, published) to ``rss_raw`` records."""
    return require(df, "link").select(
        source.alias("source"),
        category.alias("category"),
        F.coalesce("title", F.lit("")).alias("title"),
        "link",
        tx.html_to_text(F.col("description")).alias("description"),
        F.coalesce("published", F.lit("")).alias("published_at"),
        _now(now).alias("ingested_at"),
    )


def normalize_chat(df: DataFrame, now: Column | None = None) -> DataFrame:
    """Messages (channel_name, sender_id, message, sent) to ``telegram_raw``."""
    sender = F.col("sender_id").cast("string")
    known = F.when(~sender.isin("", "0"), sender)
    return df.filter(tx.strip(F.coalesce("message", F.lit(""))) != "").select(
        "channel_name",
        F.coalesce(known, F.lit("unknown")).alias("sender_id"),
        "message",
        iso_z(F.col("sent"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("sent_at"),
        _now(now).alias("ingested_at"),
    )


def normalize_post(df: DataFrame, value: str = "value") -> DataFrame:
    """JSON posts to typed ``tweet_raw`` records."""
    return df.select(F.from_json(value, schemas.POST_RAW).alias("_p")).select("_p.*")


def backfill(
    df: DataFrame, channel: str = "channel_name", order: Sequence[Column] = (), n: int = 100
) -> DataFrame:
    """Newest ``n`` messages of each channel, blank ones dropped after the cut.

    The rank limit is applied before and after the shuffle, so a channel with
    most of the messages sends only ``n`` rows per task.
    """
    order = order or (F.col("sent").desc(), F.col("message"))
    newest = Window.partitionBy(channel).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") <= n)
        .drop("_rank")
        .filter(tx.strip(F.coalesce("message", F.lit(""))) != "")
    )


def unsent(new: DataFrame, sent: DataFrame, key: str = "link") -> DataFrame:
    """Rows whose key was not sent before."""
    return new.join(sent.select(key), key, "left_anti")


def listing_articles(
    pages: DataFrame,
    html: str = "html",
    headings: Sequence[str] = ("h2", "h3"),
    keep: Sequence[str] = (),
    label: str = fv.LISTING_LABEL,
    source: str = fv.LISTING_SOURCE,
    now: Column | None = None,
) -> DataFrame:
    """Articles on listing pages: title, link, date and excerpt of each block."""
    body = F.regexp_replace(html, tx.HIDDEN, "<>")
    blocks = F.regexp_extract_all(body, F.lit(r"(?is)<article\b[^>]*>(.*?)</article\s*>"), 1)
    posts = explode_rows(pages, list(keep), blocks, "_post")
    post = F.col("_post")

    def inner(tag: str) -> Column:
        return F.regexp_extract(post, rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>", 1)

    # The first heading level that occurs in the block counts, even if blank.
    heading = F.coalesce(*[
        F.when(F.rlike(post, F.lit(rf"(?is)<{tag}\b[^>]*>.*?</{tag}\s*>")), inner(tag))
        for tag in headings
    ])
    posts = posts.withColumn("_heading", F.coalesce(heading, F.lit("")))
    glued = lambda c: tx._visible_pieces(c, "")
    posts = compute_once(posts, "title", glued(F.col("_heading"))).filter(F.col("title") != "")
    return posts.select(
        *keep,
        "title",
        tx.decode_entities(
            F.regexp_extract("_heading", r"""(?is)<a\b[^>]*?\bhref=["']([^"']*)["']""", 1)
        ).alias("link"),
        F.regexp_extract(post, r"""(?is)<time\b[^>]*?\bdatetime=["']([^"']*)["']""", 1).alias("date"),
        glued(inner("p")).alias("excerpt"),
        F.lit(label).alias("label"),
        F.lit(source).alias("source"),
        _now(now).alias("scraped_at"),
    )


_ARTICLE_FIELDS = [
    "title", "body_text", "body_html", "body", "published_at", "category", "tags", "topics", "url",
]


def flatten_pages(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """API pages (``data.data[]`` or ``data[]``) to one row per article.

    Values that are not JSON, or hold no list, give no rows.
    """
    parsed = compute_once(df.select(*keep, value), "_v", F.try_parse_json(value))
    items = F.coalesce(
        F.try_variant_get("_v", "$.data.data", "array<variant>"),
        F.try_variant_get("_v", "$.data", "array<variant>"),
    )
    rows = explode_rows(parsed, list(keep), items, "_a")
    return rows.select(
        *keep, *[F.try_variant_get("_a", f"$.{f}", "string").alias(f) for f in _ARTICLE_FIELDS]
    )


def hoax_article(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """API articles to ``hoax_article`` records.

    Body: given text, else cleaned HTML, else the cleaned plain body field.
    """
    blank = F.lit("")
    html = F.coalesce(tx.non_empty(F.col("body_html")), F.col("body"), blank)
    return df.select(
        *keep,
        F.coalesce("title", blank).alias("title"),
        F.coalesce(tx.non_empty(F.col("body_text")), tx.html_to_text(html)).alias("body_text"),
        F.coalesce("published_at", blank).alias("published_at"),
        F.coalesce("category", F.lit(fv.DEFAULT_ARTICLE_CATEGORY)).alias("category"),
        F.coalesce("tags", blank).alias("tags"),
        F.coalesce("topics", blank).alias("topics"),
        F.coalesce("url", blank).alias("url"),
        F.lit("Hoaks").alias("label"),
        F.lit(fv.ARTICLE_SOURCE).alias("source"),
    )


def drop_ocr_errors(df: DataFrame) -> DataFrame:
    """Drop failed picture readings (error text or category ERROR)."""
    return df.filter(
        ~F.startswith(F.coalesce("text", F.lit("")), F.lit(fv.OCR_FAILURE_PREFIX))
        & (F.coalesce("kategori", F.lit("")) != "ERROR")
    )
