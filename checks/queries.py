"""Every operator as a query over the given tables.

Nested results are flattened (lists joined by '|') so that any engine can
compare them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks import tables as tb
from veristream import fixed_values as fv, schemas
from veristream.functions import labels, scoring, text as tx, times
from veristream.operators import (
    curate, dash, eda, enrich, evaluate, features, feed, feedback, ingest, quality, registry,
    sampling, similarity, train,
)
from veristream.plans.verdict import verdict
from veristream.session import materialize, scratch_path, spread, tasks_for
from veristream.sources import readers, topics, writers
from veristream.sources.lake import Lake
from veristream.streaming import jobs

HOAX = ["tion der", "stion", "ouon", "the the"]
FORMAL = ["with", "des", "und"]
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def cores(spark) -> int:
    """The tables here are one file each: heavy work is dealt to all cores."""
    return spark.sparkContext.defaultParallelism


def _joined(c):
    return F.array_join(c, "|")


def _scores(name: str, prefix: str):
    return [F.col(f"{name}.{k}").alias(f"{prefix}_{k.lower()}") for k in fv.LABELS]


# --- text -------------------------------------------------------------------


def _page_text(name, f):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return tb.table(spark, sf, "pages").select("page_id", f(F.col("html")).alias("out"))

    run.__name__ = name
    return query(run)


_page_text("clean_train", tx.clean_train)
_page_text("clean_similarity", tx.clean_similarity)
_page_text("clean_serve", tx.clean_serve)
_page_text("strip_tags", tx.strip_tags)
_page_text("html_to_text", tx.html_to_text)
_page_text("article_text", tx.article_text)


@query
def container_text(spark, sf):
    return tb.table(spark, sf, "pages").select(
        "page_id", tx.container_text(F.col("html"), ["nothing", "ad"]).alias("out")
    )


@query
def scam_entities(spark, sf):
    texts = tb.table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("id"), "text"
    ).unionByName(
        tb.table(spark, sf, "pages").select(
            F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("id"),
            F.concat("url", F.lit(" "), F.lit("0812"), F.lpad(F.col("page_id").cast("string"), 8, "3"), F.lit(" wa.me/"), F.col("page_id").cast("string")).alias("text"),
        )
    )
    return texts.select("id", tx.scam_entities(F.col("text")).alias("e")).select(
        "id", *[_joined(F.col(f"e.{n}")).alias(n) for n in ("nomor_hp", "rekening", "links")]
    )


@query
def keyword_any(spark, sf):
    c = F.col("text")
    return tb.table(spark, sf, "documents").select(
        "doc_id", tx.has_any(c, HOAX).alias("hoax"), tx.has_any(c, FORMAL).alias("formal")
    )


@query
def indicator_rule(spark, sf):
    rule = scoring.indicator_rule(F.col("text"), ["the", "tion", "der", "with", "oui", "sch"], 3)
    return tb.table(spark, sf, "documents").select("doc_id", rule.alias("r")).select(
        "doc_id", _joined("r.indicators").alias("indicators"), "r.classification", "r.confidence",
        "r.recommendation",
    )


@query
def is_url(spark, sf):
    padded = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit(" "), "url", F.lit("\n"))).otherwise(
        F.concat("url", F.lit(" x"))
    )
    return tb.table(spark, sf, "pages").select("page_id", tx.is_url(padded).alias("is_url"))


@query
def ellipsis(spark, sf):
    return tb.table(spark, sf, "documents").select(
        "doc_id",
        tx.ellipsis(F.col("text")).alias("short"),
        tx.ellipsis(F.col("text"), 300, 300).alias("preview"),
        F.substring("text", 1, 500).alias("cut"),
    )


@query
def join_title(spark, sf):
    d = tb.table(spark, sf, "documents")
    title = F.when(F.col("doc_id") % 3 > 0, F.substring("text", 1, 40))
    return d.select(
        "doc_id",
        tx.join_title(title, F.col("text")).alias("dotted"),
        tx.join_title(title, F.col("text"), " ").alias("plain"),
        tx.capitalize(F.col("lang")).alias("lang_name"),
    )


@query
def recover_json(spark, sf):
    d = tb.table(spark, sf, "documents")
    bare = F.concat(F.lit('{"kategori":"'), F.upper("lang"), F.lit('","text":"t '), F.col("doc_id").cast("string"), F.lit('"}'))
    reply = (
        F.when(F.col("doc_id") % 4 == 0, bare)
        .when(F.col("doc_id") % 4 == 1, F.concat(F.lit("```json\n"), bare, F.lit("\n```")))
        .when(F.col("doc_id") % 4 == 2, F.concat(F.lit("Jawaban: "), bare, F.lit(" selesai")))
        .otherwise(F.lit("tidak ada {"))
    )
    return d.select("doc_id", tx.recover_json(reply, schemas.OCR_REPLY).alias("r")).select(
        "doc_id", "r.kategori", "r.text"
    )


@query
def hour_label(spark, sf):
    return tb.live_feed(spark, sf).select("id", times.hour_label(F.col("timestamp")).alias("hour"))


@query
def parse_time(spark, sf):
    e = tb.table(spark, sf, "events")
    shown = (
        F.when(F.col("event_id") % 4 == 0, F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss '+0700'"))
        .when(F.col("event_id") % 4 == 1, F.date_format("ts", "EEE, dd MMM yyyy HH:mm:ss 'GMT'"))
        .when(F.col("event_id") % 4 == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.lit("kemarin"))
    )
    parsed = times.parse_time(shown)
    return e.select("event_id", F.unix_timestamp(parsed).alias("epoch"))


@query
def iso_format(spark, sf):
    e = tb.table(spark, sf, "events")
    return e.select("event_id", times.iso_z(F.col("ts")).alias("iso"))


@query
def label_codes(spark, sf):
    e = tb.table(spark, sf, "events")
    spelled = tb._case(
        F.col("event_type"),
        {"error": " Penipuan ", "click": "Hoax", "view": "VALID", "purchase": "netral\t"}, "other",
    )
    return e.select(
        "event_id",
        labels.to_code(spelled).alias("code"),
        labels.feedback_code(tx.strip(spelled)).alias("feedback_code"),
        labels.normalize(spelled).alias("normal"),
        labels.in_domain(labels.normalize(spelled)).alias("known"),
        labels.is_risk(labels.normalize(spelled)).alias("risk"),
        labels.from_code(labels.to_code(spelled)).alias("name"),
    )


@query
def source_labels(spark, sf):
    flag = F.when(F.col("quality") == 1, F.lit("1.0")).when(F.col("toxic") == 1, F.lit("nan")).otherwise(F.lit("x"))
    return tb.table(spark, sf, "labels").select(
        "doc_id",
        labels.from_sms(F.col("quality") + F.col("toxic") * 2).alias("sms"),
        labels.from_flag(flag).alias("flag"),
    )


@query
def percent_clamp(spark, sf):
    e = tb.table(spark, sf, "events")
    return e.select(
        "event_id",
        scoring.pct(F.col("event_id") % 7, F.col("event_id") % 11).alias("pct"),
        scoring.clamp(F.col("value")).alias("clamped"),
    )


# --- messages and feed -------------------------------------------------------


@query
def select_text(spark, sf):
    return enrich.clean_messages(tb.messages(spark, sf)).select("event_id", "text", "problem")


@query
def dead_letters(spark, sf):
    return enrich.dead_letters(enrich.clean_messages(tb.messages(spark, sf))).select(
        "topic", "value", "reason"
    )


@query
def envelope(spark, sf):
    d = tb.table(spark, sf, "documents").select(
        "doc_id", F.to_json(F.struct("doc_id", "lang")).alias("value"), F.lit("rss-news").alias("topic"),
        F.when(F.col("doc_id") % 2 == 0, F.lit("Hoaks")).alias("label"),
        (F.col("doc_id") % 100).cast("double").alias("score"),
    )
    return enrich.envelope(d, keep=["doc_id"]).select("doc_id", "original_data", "source_topic", "analysis.*")


@query
def feed_flatten(spark, sf):
    return feed.flatten(tb.envelopes(spark, sf), keep=["event_id"])


@query
def insert_ignore(spark, sf):
    rows = feed.flatten(tb.envelopes(spark, sf), keep=["event_id"])
    seen = rows.filter(F.col("event_id") % 9 == 0)
    return feed.new_rows(rows, seen, [F.col("event_id")]).select("event_id", "id")


@query
def feed_display(spark, sf):
    return feed.display(tb.live_feed(spark, sf))


@query
def latest_feed(spark, sf):
    return feed.latest(tb.live_feed(spark, sf), 25)


@query
def feed_search(spark, sf):
    found = feed.search(
        feed.display(tb.live_feed(spark, sf)), "  USER_1 click ",
        ["time", "source", "snippet", "status", "confidence"],
    )
    return found.select("id", "source", "snippet")


@query
def dimension_search(spark, sf):
    c = tb.table(spark, sf, "customer").join(
        tb.table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    return feed.search(c, "building nation_1", ["c_mktsegment", "n_name"]).select("c_custkey", "n_name")


@query
def alerts(spark, sf):
    return feed.alerts(tb.live_feed(spark, sf), 15.0).select("id", "label", "confidence")


def _feed_table(spark, sf, use):
    """The feed rows in a table of their own: what ``use`` makes of it, and its rows afterwards."""
    path = scratch_path(spark, "feed")
    name = "veristream_feed_" + path.rsplit("-", 1)[1]
    feed.ensure_table(spark, name, path)
    try:
        rows = tb.live_feed(spark, sf)
        feed.insert_ignore(rows.filter(F.col("source_type") != "Telegram"), name)
        feed.insert_ignore(rows, name)
        n = use(name)
        # Read from its files: the name goes, they stay.
        return n, spark.read.schema(schemas.LIVE_FEED).parquet(feed._location(spark, name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


@query
def purge_table(spark, sf):
    """Rows of a kind deleted from the stored feed."""
    n, left = _feed_table(spark, sf, lambda name: feed.purge(spark, name, F.col("source_type") == "RSS"))
    return left.select("id", "source_type", "text_snippet", F.lit(n).cast("long").alias("n_deleted"))


@query
def reclean_stored(spark, sf):
    """Tags removed from the snippets of the stored feed, after some were put in."""
    path = scratch_path(spark, "feed")
    name = "veristream_feed_" + path.rsplit("-", 1)[1]
    feed.ensure_table(spark, name, path)
    try:
        tagged = F.when(F.col("source_type") == "RSS", F.concat(F.lit("<b>"), "text_snippet", F.lit("</b> &amp; <i>x</i>"))).otherwise(F.col("text_snippet"))
        feed.insert_ignore(tb.live_feed(spark, sf).withColumn("text_snippet", tagged), name)
        n = feed.reclean_table(spark, name)
        rows = spark.read.schema(schemas.LIVE_FEED).parquet(feed._location(spark, name))
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return rows.select("id", "text_snippet", F.lit(n).cast("long").alias("n_changed"))


@query
def html_references(spark, sf):
    """Character references by name and number, and a quoted '>' in a tag, before each page."""
    given = '<p title="a > b">Caf&eacute; &#8217;&#x2026;&amp;lt; &nosuch; &#150;&copy</p>'
    return tb.table(spark, sf, "pages").select("page_id", tx.html_to_text(F.concat(F.lit(given), "html")).alias("out"))


@query
def length_shifted(spark, sf):
    """Statistics of lengths beyond 10^9, whose squares would cancel."""
    d = eda.describe_values(tb.table(spark, sf, "documents").select((F.length("text") + F.lit(10**9)).alias("x")), "x")
    return d.select("count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "p25", "p50", "p75", "max")


@query
def first_existing(spark, sf):
    """The first source that is there, of three, and an empty one for none."""
    ddl = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])
    found = readers.first_existing(spark, [f"{sf}/missing.parquet", f"{sf}/benchmark.parquet", f"{sf}/documents.parquet"], ddl)
    none = readers.first_existing(spark, [f"{sf}/missing.parquet", f"{sf}/missing2.parquet"], ddl)
    return found.unionByName(none).select("item_id", F.md5("text").alias("text_md5"))


@query
def purge(spark, sf):
    return feed.delete_where(tb.live_feed(spark, sf), F.col("source_type") == "RSS").select("id", "source_type")


@query
def reclean(spark, sf):
    rows = tb.table(spark, sf, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 3 == 0, F.col("url")).otherwise(F.col("html")).alias("text_snippet"),
    )
    return feed.reclean(rows)


@query
def reclean_count(spark, sf):
    rows = tb.table(spark, sf, "pages").select(F.col("html").alias("text_snippet"))
    return feed.reclean(rows).agg(F.count_if("changed").alias("n_changed"))


# --- dashboard ----------------------------------------------------------------


@query
def total_rows(spark, sf):
    return dash.total(tb.live_feed(spark, sf))


@query
def label_counts(spark, sf):
    return dash.label_counts(tb.live_feed(spark, sf))


@query
def label_share(spark, sf):
    return dash.label_share(tb.live_feed(spark, sf))


@query
def log_stats(spark, sf):
    rows = tb.live_feed(spark, sf)
    return dash.log_stats(rows.withColumn("label", F.when(F.col("topic") != "7", F.col("label"))))


@query
def active_sources(spark, sf):
    return dash.active_sources(tb.live_feed(spark, sf))


@query
def hourly_volume(spark, sf):
    return dash.hourly_volume(tb.live_feed(spark, sf))


@query
def risk_sources(spark, sf):
    return dash.risk_sources(tb.live_feed(spark, sf))


@query
def risk_share(spark, sf):
    return dash.risk_share(dash.risk_sources(tb.live_feed(spark, sf)))


@query
def bar_heights(spark, sf):
    return dash.bar_heights(dash.hourly_volume(tb.live_feed(spark, sf)))


@query
def stats_snapshot(spark, sf):
    s = dash.snapshot(tb.live_feed(spark, sf), now=F.lit("now"))
    points = lambda c: F.array_join(
        F.transform(c, lambda p: F.concat(p["label"], F.lit("="), p["value"].cast("string"))), "|"
    )
    return s.select(
        "total_messages_today", "hoax_detected_today", "scam_detected_today", "valid_detected_today",
        "hoax_vs_valid_percent.*", "active_sources", "last_updated",
        points("hourly_volume").alias("hourly_volume"), points("risk_scatter").alias("risk_scatter"),
    )


# --- looking at data -----------------------------------------------------------


@query
def value_counts(spark, sf):
    return eda.value_counts(tb.table(spark, sf, "documents"), "lang")


@query
def value_shares(spark, sf):
    shares = eda.value_counts(tb.table(spark, sf, "documents"), "source", normalize=True)
    return shares.select("source", F.round("share", 9).alias("share"))


@query
def length_describe(spark, sf):
    out = eda.describe(tb.table(spark, sf, "documents"), "text")
    return out.select(
        "count", F.round("mean", 4).alias("mean"), F.round("std", 4).alias("std"), "min", "p25",
        "p50", "p75", "max",
    )


@query
def class_samples(spark, sf):
    return eda.samples(tb.labeled(spark, sf), 2, "final_label", "doc_id")


# --- lake ----------------------------------------------------------------------


@query
def silver_union(spark, sf):
    return curate.union_sources(tb.silver_sources(spark, sf)).select(
        "row_id", "final_label", "source", F.md5("text").alias("text_md5")
    )


@query
def silver_build(spark, sf):
    return curate.build_silver(tb.silver_sources(spark, sf)).select(
        "final_label", "source", F.md5("text").alias("text_md5")
    )


@query
def dedup_keep_first(spark, sf):
    d = tb.table(spark, sf, "documents")
    return curate.dedup_keep_first(d, ["text"], [F.col("doc_id")]).select("doc_id", "source")


@query
def min_length(spark, sf):
    return curate.min_length(tb.table(spark, sf, "documents"), 400).select("doc_id")


@query
def drop_null(spark, sf):
    rows = tb.table(spark, sf, "documents").join(tb.table(spark, sf, "labels"), "doc_id", "left")
    return curate.drop_null(rows, ["quality", "text"]).select("doc_id", "quality")


@query
def gold_balanced(spark, sf):
    picked = sampling.balance(_with_gaps(tb.labeled(spark, sf), "final_label"), fv.GOLD_PER_CLASS, 42, key="doc_id")
    return picked.select("doc_id", "final_label", F.md5("text").alias("text_md5"))


def _with_gaps(rows, *columns):
    """Nulls in some rows of the columns, each in other rows."""
    return rows.withColumns({
        c: F.when(F.col("doc_id") % 10 != 3 + k, F.col(c)) for k, c in enumerate(columns)
    })


@query
def stratified_split(spark, sf):
    rows = _with_gaps(tb.labeled(spark, sf), "final_label", "doc_id")
    return sampling.split(rows, key="doc_id").select("doc_id", "final_label", "part", F.md5("text").alias("text_md5"))


@query
def three_way_split(spark, sf):
    rows = _with_gaps(tb.labeled(spark, sf), "final_label")
    parts = [("test", "0.15"), ("val", "0.15"), ("train", "0.7")]
    return sampling.split(rows, parts, key="doc_id").select("doc_id", "final_label", "part", F.md5("text").alias("text_md5"))


@query
def shuffled(spark, sf):
    d = tb.table(spark, sf, "documents").select("doc_id", "source")
    return sampling.shuffle(d, 42, "doc_id")


@query
def class_weights(spark, sf):
    rows = tb.labeled(spark, sf).select(labels.to_code(F.col("final_label")).alias("label_num"))
    return train.class_weights(rows).select("label_num", "n", F.round("weight", 9).alias("weight"))


@query
def assert_classes(spark, sf):
    return quality.assert_classes(tb.labeled(spark, sf))


@query
def unprocessed(spark, sf):
    return curate.unprocessed(
        tb.table(spark, sf, "documents").select("doc_id", "source"), tb.table(spark, sf, "labels"), "doc_id"
    )


@query
def run_summary(spark, sf):
    d = tb.table(spark, sf, "documents").select(
        "doc_id", tb._case(F.col("lang"), {"en": "Penipuan", "fr": "ERROR"}, "VALID").alias("kategori")
    )
    return curate.run_summary(d, tb.table(spark, sf, "labels"), "doc_id")


@query
def train_prepare(spark, sf):
    rows = tb.labeled(spark, sf)
    return train.prepare(rows).select(F.md5("text_clean").alias("text_md5"), "label_num")


# --- verdict ---------------------------------------------------------------------


@query
def heuristic_boost(spark, sf):
    d = tb.base_scores(tb.table(spark, sf, "documents"))
    c = F.col("text")
    out = d.select(
        "doc_id", scoring.boost(F.col("base"), tx.has_any(c, HOAX), tx.has_any(c, FORMAL)).alias("b")
    )
    return out.select("doc_id", *[F.round(c, 2).alias(n) for c, n in [("b.Valid", "b_valid"), ("b.Hoaks", "b_hoaks"), ("b.Penipuan", "b_penipuan"), ("b.Netral", "b_netral")]])


def _verdicts(spark, sf):
    d = tb.base_scores(tb.table(spark, sf, "documents"))
    return verdict(d, deep=tb.deep_scores(spark, sf), hoax_words=HOAX, formal_words=FORMAL)


@query
def hybrid_fusion(spark, sf):
    return _verdicts(spark, sf).select("doc_id", "label", "score", *_scores("all_scores", "s"))


@query
def verdict_record(spark, sf):
    v = _verdicts(spark, sf)
    return v.select(
        "doc_id", "label", "score", "recommendation",
        *_scores("indobert_scores", "deep"),
        F.round("baseline_scores.Hoaks", 2).alias("base_hoaks"),
        _joined("scam_entities.rekening").alias("rekening"),
    )


@query
def render_verdict(spark, sf):
    return scoring.render(_verdicts(spark, sf)).select("doc_id", "rendered")


@query
def screenshot_verdict(spark, sf):
    d = tb.base_scores(tb.table(spark, sf, "documents"))
    lit = F.lit
    d = d.withColumns(
        {
            "kategori": tb._case(F.col("doc_id") % 4, {0: "PENIPUAN", 1: "HOAX", 2: "valid"}),
            "alasan": F.when(F.col("doc_id") % 2 == 0, lit("sebab")),
            "entitas_penipu": F.struct(
                F.when(F.col("doc_id") % 3 == 0, lit("0811")).otherwise(lit("")).alias("nomor_hp"),
                lit("99").alias("rekening"),
            ),
            "text": F.when(F.col("doc_id") % 10 == 9, F.concat(lit(fv.OCR_FAILURE_PREFIX), "text"))
            .otherwise(F.concat(lit("hubungi 081299998888 "), "text")),
        }
    )
    merged = scoring.merge_ocr(verdict(d, deep=tb.deep_scores(spark, sf), hoax_words=HOAX, formal_words=FORMAL))
    return scoring.render_screenshot(merged).select(
        "doc_id", "label", "ocr_label", "hybrid_label", "score", "recommendation",
        F.col("scam_entities.nomor_hp").alias("nomor_hp"), "ocr_reason", "rendered",
    )


# --- features and similarity -------------------------------------------------------


def _stats(spark, sf):
    docs = tb.table(spark, sf, "documents").select("text")
    docs = spread(docs, tasks_for(docs, "text", cores(spark)))
    return features.term_stats(docs.select(tx.clean_train(F.col("text")).alias("clean")), "clean")


@query
def idf_table(spark, sf):
    stats = features.idf(_stats(spark, sf), features.count_docs(tb.table(spark, sf, "documents")))
    return stats.select("term", "total", "df", F.round("idf", 9).alias("idf"))


@query
def vocabulary(spark, sf):
    return features.vocabulary(_stats(spark, sf))


@query
def tfidf_long(spark, sf):
    docs = tb.table(spark, sf, "documents").select("doc_id", "text")
    tasks = tasks_for(docs, "text", cores(spark))
    docs = spread(docs, tasks).select("doc_id", tx.clean_train(F.col("text")).alias("clean"))
    return features.tfidf(docs, "doc_id", "clean", partitions=tasks).select(
        "doc_id", "term", F.round("weight", 9).alias("weight")
    )


def _matches(spark, sf, k, threshold):
    index = similarity.build_index(tb.corpus(spark, sf), partitions=cores(spark))
    d = tb.table(spark, sf, "documents")
    return d, similarity.topk(d, index, "doc_id", "text", k, threshold, cores(spark))


@query
def similarity_topk(spark, sf):
    _, m = _matches(spark, sf, 3, 0.3)
    return m.select("query_id", "rank", "article_id", "title", "url", "category", "similarity")


@query
def similarity_saved(spark, sf):
    """An index that knows how common terms are among the texts to come, saved, loaded, and left in place."""
    path = scratch_path(spark, "index")
    d = tb.table(spark, sf, "documents")
    texts = spread(d.select("text"), cores(spark)).select(tx.clean_similarity(F.col("text")).alias("_clean"))
    similarity.build_index(tb.corpus(spark, sf), partitions=cores(spark), texts=texts).save(path, cores(spark))
    index = similarity.Index.load(spark, path)
    m = similarity.topk(d, index, "doc_id", "text", 3, 0.3, cores(spark), reorder=False)
    return m.select("query_id", "rank", "article_id", "title", "url", "category", "similarity")


@query
def similarity_reason(spark, sf):
    d, m = _matches(spark, sf, 1, 0.5)
    return similarity.reason(d.select("doc_id"), m, "doc_id")


# --- training, evaluation, feedback ---------------------------------------------------


def _predicted(spark, sf):
    """Classes of labelled documents against a rule on their length."""
    rows = tb.labeled(spark, sf)
    return rows.select(
        labels.to_code(F.col("final_label")).alias("label_num"),
        F.when(F.length("text") < 300, 3).when(F.length("text") < 600, 1).otherwise(0).alias("prediction"),
    )


@query
def eval_summary(spark, sf):
    s = evaluate.summary(_predicted(spark, sf))
    return s.select(*[F.round(c, 9).alias(c) for c in s.columns])


@query
def eval_report(spark, sf):
    r = evaluate.report(_predicted(spark, sf))
    return r.select("label", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")], "support")


@query
def confusion(spark, sf):
    return evaluate.confusion(_predicted(spark, sf))


@query
def lr_train_score(spark, sf):
    """Model on the training part; how it does on the test part."""
    rows = sampling.split(tb.labeled(spark, sf), key="doc_id")
    model = train.fit(train.prepare(rows.filter("part = 'train'")), max_iter=200, partitions=cores(spark))
    scored = train.predict(train.prepare(rows.filter("part = 'test'")), model)
    return evaluate.summary(scored)


@query
def model_scores(spark, sf):
    """Class scores of all documents by a model trained on the labelled ones, saved and loaded."""
    path = scratch_path(spark, "model")
    train.save(train.fit(train.prepare(tb.labeled(spark, sf)), max_iter=200, partitions=cores(spark)), path)
    model = train.load(spark, path)
    scored = train.score(tb.table(spark, sf, "documents"), model)
    return scored.select("doc_id", *_scores("base", "base"))


@query
def feedback_codes(spark, sf):
    e = tb.table(spark, sf, "events").select(
        "event_id",
        F.concat(F.lit("Teks <b>"), "props", F.lit("</b>")).alias("text"),
        tb._case(F.col("event_type"), {"error": "Penipuan", "click": "Hoax", "view": "valid", "purchase": "Netral"}).alias("correct_label"),
    )
    return feedback.codes(e)


def _corrections(spark, sf):
    return feedback.codes(
        tb.labeled(spark, sf).select(
            F.col("doc_id").alias("row_id"), "text",
            F.when(F.col("doc_id") % 2 == 0, F.lit("Hoax")).otherwise(F.lit("Penipuan")).alias("correct_label"),
        )
    )


@query
def feedback_training_set(spark, sf):
    original = tb.labeled(spark, sf).filter(F.col("doc_id") % 3 == 0).withColumnRenamed("doc_id", "row_id")
    out = feedback.training_set(original, _corrections(spark, sf))
    return out.select(F.md5("text").alias("text_md5"), "label_num")


def _feedback_files(labeled, folder, parts):
    rows = labeled.withColumn("_part", F.col("doc_id") % parts)
    said = F.when(F.col("doc_id") % 2 == 0, F.lit("Hoax")).otherwise(F.lit("Penipuan"))
    for k in range(parts):
        lines = rows.filter(F.col("_part") == k).select(F.to_json(F.struct("text", said.alias("correct_label"))).alias("value"))
        lines.write.text(f"{folder}/{k}")
        yield k


@query
def feedback_retrain(spark, sf):
    """Two runs over corrections from labels: the pool, with the number of the run a text came in."""
    root = scratch_path(spark, "feedback")
    # Documents meet their labels once, for both logs and both runs.
    labeled = materialize(tb.labeled(spark, sf).select("doc_id", "text", "final_label"), "labeled")
    original = labeled.select("text", "final_label")
    # The pool and the archive are looked at here; the model needs few terms for that.
    fit = lambda rows: train.fit(rows, n_max=200, max_iter=20, partitions=cores(spark))
    for _ in _feedback_files(labeled, f"{root}/log", 2):
        feedback.retrain(spark, f"{root}/log", original, f"{root}/model", f"{root}/pool", f"{root}/archive", fit=fit)
    lines = spark.read.text(f"{root}/archive").count()
    pool = spark.read.parquet(f"{root}/pool")
    return pool.select(F.md5("text").alias("text_md5"), "label_num", "run", F.lit(lines).cast("long").alias("n_archived"))


@query
def feedback_trigger(spark, sf):
    """Corrections from labels as a stream; a retraining whenever a hundred new ones have come."""
    root = scratch_path(spark, "feedback")
    trainings = []
    for k in _feedback_files(tb.labeled(spark, sf), f"{root}/in", 3):
        lines = jobs.feedback_lines(spark, f"{root}/in/{{{','.join(map(str, range(k + 1)))}}}")
        _run(jobs.feedback_trigger(lines, 100, lambda: trainings.append(1), f"{root}/pool", f"{root}/checkpoint"))
    stored = spark.read.schema(schemas.STORED_FEEDBACK).parquet(f"{root}/pool/rows")
    return stored.select(F.md5("text").alias("text_md5"), "label_num", F.lit(len(trainings)).cast("long").alias("n_trainings"))


@query
def feedback_pool(spark, sf):
    new = _corrections(spark, sf)
    out = feedback.merge_pool(new.filter(F.col("row_id") % 4 == 1), new)
    return out.select(F.md5("text").alias("text_md5"), "label_num")


# --- registry ---------------------------------------------------------------------------


@query
def registry_apply(spark, sf):
    return registry.apply_changes(tb.registry(spark, sf), tb.registry_changes(spark, sf))


@query
def registry_rejected(spark, sf):
    return registry.rejected(tb.registry(spark, sf), tb.registry_changes(spark, sf))


@query
def registry_lookup(spark, sf):
    ids = tb.registry_changes(spark, sf).select("id").distinct()
    return registry.lookup(tb.registry(spark, sf), ids).select("id", "identifier_value", "error")


@query
def registry_kpis(spark, sf):
    return registry.kpis(tb.registry(spark, sf))


@query
def registry_display(spark, sf):
    return registry.display(tb.registry(spark, sf))


@query
def registry_list(spark, sf):
    return registry.list_newest(tb.registry(spark, sf)).select("id", "created_at")


@query
def registry_ids(spark, sf):
    return tb.table(spark, sf, "customer").select(
        "c_custkey", registry.make_id(F.lit("bank_account"), F.col("c_name")).alias("id")
    )


@query
def registry_validate(spark, sf):
    _, bad = quality.split_valid(tb.registry(spark, sf), quality.scam_record_rules())
    return bad.select("id", _joined("reasons").alias("reasons"))


@query
def registry_valid(spark, sf):
    ok, _ = quality.split_valid(tb.registry(spark, sf), quality.scam_record_rules())
    return ok.select("id")


@query
def feed_validate(spark, sf):
    rows = tb.live_feed(spark, sf).withColumn("confidence", F.col("confidence") * 8)
    return quality.check(rows, quality.live_feed_rules()).select("id", _joined("reasons").alias("reasons"))


# --- ingestion --------------------------------------------------------------------------


def _items(spark, sf):
    p = tb.table(spark, sf, "pages")
    return p.select(
        "page_id",
        F.when(F.col("page_id") % 8 > 0, F.col("url")).alias("link"),
        F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"),
        F.col("html").alias("description"),
        F.lit("Mon, 29 Jun 2026 10:00:00 +0700").alias("published"),
    )


@query
def normalize_rss(spark, sf):
    return ingest.normalize_rss(_items(spark, sf), F.lit("Detik News"), F.lit("news"), F.lit("now"))


@query
def normalize_chat(spark, sf):
    return ingest.normalize_chat(_chat(spark, sf), F.lit("now"))


def _chat(spark, sf):
    c = tb.table(spark, sf, "conversations")
    return c.select(
        F.concat(F.lit("ch"), (F.col("conv_id") % 3).cast("string")).alias("channel_name"),
        F.when(F.col("turn") % 3 > 0, F.col("turn")).alias("sender_id"),
        F.when((F.col("conv_id") + F.col("turn")) % 5 > 0, F.col("text")).otherwise(F.lit(" \n")).alias("message"),
        F.timestamp_seconds(F.col("conv_id") * 100 + F.col("turn") + 1700000000).alias("sent"),
        "conv_id", "turn",
    )


@query
def backfill(spark, sf):
    newest = ingest.backfill(
        _chat(spark, sf), order=[F.col("sent").desc(), F.col("conv_id"), F.col("turn")], n=100
    )
    return newest.select("channel_name", "conv_id", "turn")


@query
def normalize_post(spark, sf):
    e = tb.table(spark, sf, "events")
    k = F.col("event_id").cast("string")
    value = F.concat(
        F.lit('{"tweet_id":"tw_'), k, F.lit('","text":"'), "event_type",
        F.lit('","account_age_days":'), F.col("user_id").cast("string"),
        F.lit(',"entities":{"links":["bit.ly/'), k, F.lit('","x"]},"metrics":{"likes":'), k,
        F.lit(',"views":5},"scam_type":null}'),
    )
    posts = ingest.normalize_post(e.select(value.alias("value")))
    return posts.select(
        "tweet_id", "text", "account_age_days", F.col("metrics.likes").alias("likes"),
        F.col("metrics.replies").alias("replies"), _joined(F.col("entities")["links"]).alias("links"), "scam_type",
    )


@query
def listing_articles(spark, sf):
    return ingest.listing_articles(
        tb.table(spark, sf, "pages"), headings=("h2", "h1"), keep=["page_id"], now=F.lit("now")
    )


@query
def hoax_articles(spark, sf):
    """Pages of the two API shapes made of documents, back to articles."""
    d = tb.table(spark, sf, "documents")
    article = F.struct(
        F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("title"),
        F.when(F.col("doc_id") % 2 == 0, F.col("text")).otherwise(F.lit("")).alias("body_text"),
        F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit("<p>"), F.regexp_replace("text", "[<>&]", ""), F.lit("</p>"))).alias("body_html"),
        F.when(F.col("doc_id") % 3 == 0, F.lit("hoaks kesehatan")).alias("category"),
    )
    grouped = d.groupBy((F.col("doc_id") % 97).alias("page"), (F.col("doc_id") / 50).cast("bigint").alias("part")).agg(
        F.collect_list(article).alias("a")
    )
    value = F.when(F.col("page") % 2 == 0, F.to_json(F.struct(F.struct(F.col("a").alias("data")).alias("data")))).otherwise(
        F.to_json(F.struct(F.col("a").alias("data")))
    )
    flat = ingest.flatten_pages(grouped.select(value.alias("value")))
    return ingest.hoax_article(flat).select("title", F.md5("body_text").alias("body_md5"), "category", "url", "label", "source")


@query
def article_load(spark, sf):
    """Articles with enough text, first one per title, and nothing null."""
    d = tb.table(spark, sf, "documents").withColumn("title", F.get(F.split("text", "\n"), 0))
    kept = curate.dedup_keep_first(d, ["title"], [F.col("doc_id")])
    return curate.drop_null(curate.min_length(kept, fv.MIN_ARTICLE_CHARS), ["text"]).select("doc_id", "title")


@query
def feed_dimension(spark, sf):
    d = tb.table(spark, sf, "documents").select(
        "doc_id",
        tb._case(F.col("source"), {"src1": "Detik News", "src2": "Turnbackhoax", "src3": "Antara Tekno"}, "blog").alias("source"),
    )
    return ingest.attach_feed(d)


@query
def feed_dimension_table(spark, sf):
    feeds = tb.table(spark, sf, "nation").select(
        F.concat(F.lit("src"), F.col("n_nationkey").cast("string")).alias("source"),
        F.col("n_name").alias("category"),
    )
    return ingest.attach_feed(tb.table(spark, sf, "documents").select("doc_id", "source"), feeds)


@query
def unsent_links(spark, sf):
    items = _items(spark, sf).withColumnRenamed("published", "p")
    sent = items.filter(F.col("page_id") % 3 == 0)
    return ingest.unsent(ingest.require(items, "link"), sent, "link").select("page_id", "link")


@query
def ocr_rows(spark, sf):
    d = tb.table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 5 == 0, F.lit(" ")).otherwise(F.concat(F.lit(" "), "text")).alias("text"),
        tb._case(F.col("lang"), {"en": "penipuan", "fr": "ERROR"}, "VALID").alias("kategori"),
    )
    return curate.ocr_rows(ingest.drop_ocr_errors(d)).select(F.md5("text").alias("text_md5"), "final_label", "source")


@query
def topic_summary(spark, sf):
    m = tb.messages(spark, sf).select(
        "value", (F.col("event_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset")
    )
    return topics.topic_summary(m)


@query
def manifest(spark, sf):
    return writers.manifest(tb.table(spark, sf, "documents"), "documents", "Hoaks", F.lit("now"))


# --- files: written by Spark from a table, then read by our readers ------------------------


@query
def csv_scan(spark, sf):
    path = scratch_path(spark, "csv")
    d = tb.table(spark, sf, "documents").select("doc_id", "text", "lang")
    writers.export_csv(d, path, ["doc_id", "text", "lang"])
    read = readers.read_csv(spark, path, T.StructType.fromDDL("doc_id bigint, text string, lang string"))
    return read.select("doc_id", "lang", F.length("text").alias("n"))


@query
def glob_union(spark, sf):
    root = scratch_path(spark, "glob")
    d = tb.table(spark, sf, "documents")
    d.filter("doc_id % 2 = 0").select("doc_id", "lang").write.csv(f"{root}/a", header=True)
    d.filter("doc_id % 2 = 1").select("doc_id", F.col("source").alias("origin")).write.csv(f"{root}/b", header=True)
    read = readers.read_glob(spark, f"{root}/*/*.csv", "csv", "file_")
    return read.select("doc_id", "lang", "origin", F.substring("source", 1, 10).alias("source"))


@query
def json_array_scan(spark, sf):
    path = scratch_path(spark, "array")
    d = tb.table(spark, sf, "documents").groupBy((F.col("doc_id") / 100).cast("bigint").alias("g")).agg(
        F.collect_list(F.struct(F.lit("PENIPUAN").alias("kategori"), F.col("lang").alias("text"), F.col("doc_id").cast("string").alias("filename"))).alias("a")
    )
    d.select(F.to_json("a").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return readers.read_json_array(spark, path, schemas.OCR_RESULT).select("filename", "kategori", "text")


@query
def jsonl_scan(spark, sf):
    path = scratch_path(spark, "jsonl")
    tb.messages(spark, sf).select(
        F.when(F.col("event_id") % 10 == 9, F.lit("  ")).otherwise(F.col("value")).alias("value")
    ).write.text(path)
    good, _ = readers.read_jsonl(spark, path, T.StructType.fromDDL("message string, title string, text string"))
    return good


@query
def jsonl_bad_lines(spark, sf):
    path = scratch_path(spark, "jsonl")
    tb.messages(spark, sf).select("value").write.text(path)
    _, bad = readers.read_jsonl(spark, path, T.StructType.fromDDL("message string, title string, text string"))
    return bad


@query
def rss_scan(spark, sf):
    path = scratch_path(spark, "rss")
    p = tb.table(spark, sf, "pages")
    items = p.select(
        F.col("url").alias("link"),
        F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("title"),
        F.when(F.col("page_id") % 2 == 0, F.lit("ringkas")).alias("summary"),
        F.lit("<b>isi</b>").alias("description"),
    )
    items.write.format("xml").option("rootTag", "channel").option("rowTag", "item").save(path)
    return readers.read_rss(spark, path)


@query
def atom_scan(spark, sf):
    """Pages as entries of Atom files, some with several links, with a summary or content."""
    path, second = scratch_path(spark, "atom"), scratch_path(spark, "atom")
    p = tb.table(spark, sf, "pages")
    link = lambda rel, href: F.struct(href.alias("_href"), F.lit(rel).cast("string").alias("_rel"))
    title = F.concat(F.lit("page "), F.col("page_id").cast("string")).alias("title")
    p.select(
        title, F.array(link("self", F.lit("http://self")), link("alternate", F.col("url"))).alias("link"),
        F.when(F.col("page_id") % 2 == 0, F.lit("ringkas")).alias("summary"), F.lit("isi").alias("content"),
        F.when(F.col("page_id") % 3 == 0, F.lit("2024-01-02T03:04:05Z")).alias("published"), F.lit("2024-05-06T07:08:09Z").alias("updated"),
    ).write.format("xml").option("rootTag", "feed").option("rowTag", "entry").save(path)
    p.select(title, F.array(link(None, F.col("url"))).alias("link"), F.lit("kedua").alias("content")).write.format("xml").option(
        "rootTag", "feed"
    ).option("rowTag", "entry").save(second)
    return readers.read_rss(spark, [path, second])


@query
def history_then_live(spark, sf):
    """Messages there before the hand-over as a table, later ones as a stream, each once."""
    folder, out = scratch_path(spark, "topics"), scratch_path(spark, "live")

    def send(part):
        for name in fv.INPUT_TOPICS:
            chosen = (F.col("topic") == name) & (F.col("event_id") % 2 == part)
            tb.messages(spark, sf).filter(chosen).select("value").write.mode("append").text(f"{folder}/{name}")

    send(0)
    topics.history_then_live(spark, f"{out}/handover", folder=folder)
    send(1)
    history, live = topics.history_then_live(spark, f"{out}/handover", folder=folder)  # as after a restart
    _run(jobs.run_to_parquet(live.select("topic", "value"), f"{out}/rows", f"{out}/checkpoint"))
    after = spark.read.parquet(f"{out}/rows")
    return history.select("topic", "value", F.lit(True).alias("history")).unionByName(after.withColumn("history", F.lit(False)))


@query
def lake_roundtrip(spark, sf):
    lake = Lake(scratch_path(spark, "lake"))
    lake.write(tb.labeled(spark, sf).select("text", "final_label", "source"), "silver", "labeled")
    read = lake.read(spark, "silver", "labeled", schemas.LABELED_TEXT)
    return read.groupBy("final_label").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("n_chars"))


@query
def prediction_log(spark, sf):
    path = scratch_path(spark, "log")
    writers.append_log(_verdicts(spark, sf), path)
    good, _ = readers.read_jsonl(spark, path, schemas.PREDICTION_LOG)
    return dash.log_stats(good)


# --- streams ---------------------------------------------------------------------------------


def _run(q):
    q.awaitTermination()
    if q.exception():
        raise q.exception()


def _topic_folder(spark, sf):
    folder = scratch_path(spark, "topics")
    for name in fv.INPUT_TOPICS:
        tb.messages(spark, sf).filter(F.col("topic") == name).select("value").write.text(f"{folder}/{name}")
    return folder


@query
def stream_enrich(spark, sf):
    """All messages through the enrichment stream to the output topic."""
    folder, out = _topic_folder(spark, sf), scratch_path(spark, "analyzed")
    scorer = lambda df: verdict(df, hoax_words=["click", "b"], formal_words=["view"])
    stream = topics.read_topics(spark, folder=folder)
    _run(jobs.run_enrich(stream, fv.OUTPUT_TOPIC, f"{out}/checkpoint", scorer, folder=out))
    read = topics.read_topics_bounded(spark, [fv.OUTPUT_TOPIC], folder=f"{out}/{fv.OUTPUT_TOPIC}")
    return enrich.parse_envelope(read).select(
        "source_topic", "analysis.label", "analysis.score", "analysis.recommendation",
        F.get_json_object("original_data", "$.title").alias("title"),
    )


@query
def stream_reason(spark, sf):
    """Documents as chat messages through the enrichment stream, with the look-up of verified hoaxes."""
    folder, out = scratch_path(spark, "topics"), scratch_path(spark, "analyzed")
    d = spread(tb.table(spark, sf, "documents"), cores(spark))
    d.select(F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("message")))).write.text(f"{folder}/{fv.INPUT_TOPICS[0]}")
    index = similarity.build_index(tb.corpus(spark, sf), partitions=cores(spark))
    stream = topics.read_topics(spark, folder=folder, files_per_trigger=cores(spark) // 2 or 1)
    _run(jobs.run_enrich(stream, fv.OUTPUT_TOPIC, f"{out}/checkpoint", index=index, folder=out))
    read = topics.read_topics_bounded(spark, [fv.OUTPUT_TOPIC], folder=f"{out}/{fv.OUTPUT_TOPIC}")
    return enrich.parse_envelope(read).select(
        F.get_json_object("original_data", "$.id").cast("long").alias("doc_id"), "analysis.reason"
    )


@query
def stream_dead_letters(spark, sf):
    folder, out = _topic_folder(spark, sf), scratch_path(spark, "dead")
    stream = topics.read_topics(spark, folder=folder)
    _run(jobs.run_dead_letters(stream, "dead-letters", f"{out}/checkpoint", folder=out))
    read = readers.parse_lines(
        spark.read.text(f"{out}/dead-letters"), T.StructType.fromDDL("topic string, value string, reason string")
    )
    return read.select("topic", "value", "reason")


@query
def stream_feed(spark, sf):
    """All envelopes through the feed loader; ids stay unique."""
    src, out = scratch_path(spark, "envelopes"), scratch_path(spark, "feed")
    wrapped = tb.envelopes(spark, sf).withColumn(
        "analysis", F.struct("analysis.score", "analysis.label", "analysis.category")
    )
    # As a broker's rows, with the place of each message.
    at = tb.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("timestamp"))
    log = wrapped.join(at, "event_id").select(
        "event_id", "timestamp", F.to_json(F.struct(F.try_parse_json("original_data").alias("original_data"), "source_topic", "analysis")).alias("value")
    )
    log = log.select(
        "value", "timestamp", (F.col("event_id") % 3).cast("int").alias("partition"), F.col("event_id").alias("offset")
    )
    log.write.parquet(src)
    name = "veristream_feed_" + out.rsplit("-", 1)[1]
    feed.ensure_table(spark, name, out)
    try:
        stream = spark.readStream.schema(log.schema).parquet(src)
        _run(jobs.load_feed(stream, name, f"{out}-checkpoint"))
    finally:
        # The table is external: the files stay, only the name goes.
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return spark.read.schema(schemas.LIVE_FEED).parquet(out).select("id", "source", "source_type", "timestamp", "text_snippet")


def _event_stream(spark, sf):
    schema = tb.table(spark, sf, "events").schema
    # A glob, since a stream wants a folder or a pattern and the table may be one file.
    s = spark.readStream.schema(schema).parquet(f"{sf}/{{events.parquet}}")
    return s.withColumn("ts", F.col("ts").cast("timestamp"))


@query
def stream_dedup(spark, sf):
    out = scratch_path(spark, "dedup")
    keyed = _event_stream(spark, sf).select(
        F.concat_ws("/", F.col("user_id").cast("string"), "event_type").alias("link"), "ts"
    )
    _run(jobs.run_to_parquet(jobs.dedup(keyed, "link", "ts", "3650 days"), out, f"{out}-checkpoint"))
    return spark.read.parquet(out).select("link")


@query
def stream_hourly(spark, sf):
    """Hours that are over for good at the end of the stream."""
    out = scratch_path(spark, "hourly")
    rows = _event_stream(spark, sf).select("ts", tb._case(F.col("event_type"), tb.EVENT_LABELS).alias("label"))
    _run(jobs.run_to_parquet(jobs.hourly(rows, "ts", "10 minutes"), out, f"{out}-checkpoint"))
    return spark.read.parquet(out).select(
        F.unix_timestamp("hour_start").alias("hour_start"), "n_messages", "n_risk"
    )


@query
def stream_link_surge(spark, sf):
    out = scratch_path(spark, "surge")
    rows = _event_stream(spark, sf).select(
        "ts", F.concat(F.lit("bit.ly/"), "event_type").alias("link"), (F.col("user_id") % 20).alias("channel")
    )
    _run(jobs.run_to_parquet(jobs.link_surge(rows), out, f"{out}-checkpoint"))
    # The estimate is exact for so few channels.
    return spark.read.parquet(out).select(
        F.unix_timestamp("window_start").alias("window_start"), "link", "n_uses", "n_channels"
    )
