"""Feed table, message shapes, dashboard edges, registry folding, checks."""

import json

import pytest
from pyspark.sql import functions as F

from veristream import schemas
from veristream.operators import curate, dash, enrich, feed, ingest, quality, registry
from veristream.sources import files


def test_text_choice(spark):
    values = {
        '{"title":"A","description":""}': ("", "blank text"), '{"message":"m","text":"t"}': ("t", None),
        '{"text":null,"message":"m"}': (None, "no text"), "bukan json": (None, "not json"), '"x"': (None, "not json"),
        '{"title":"<b>a</b>  b"}': ("a b", None), '{"other":1}': ("", "blank text"), '{"message":5}': (None, "no text"),
    }
    df = spark.createDataFrame([(v,) for v in values], "value string")
    cleaned = enrich.clean_messages(df)
    assert {r["value"]: r["text"] for r in cleaned.collect()} == {v: t for v, (t, _) in values.items()}
    bad = {r["value"]: r["reason"] for r in enrich.dead_letters(cleaned).collect()}
    assert bad == {v: r for v, (_, r) in values.items() if r}
    assert {r["value"] for r in enrich.usable(cleaned).collect()} == {v for v, (_, r) in values.items() if not r}


def envelope(**original):
    return (json.dumps(original), "telegram-messages", (90.0, None, None))


ENV = "original_data string, source_topic string, analysis struct<score:double,label:string,category:string>"


def test_flatten_strict_and_ids(spark):
    df = spark.createDataFrame([envelope(message="m", channel_name="c", sent_at="2026-01-01T05:00:00Z")] * 2, ENV)
    loose = feed.flatten(df).collect()
    assert loose[0] == loose[1]  # replays give the same id
    assert (loose[0]["source"], loose[0]["timestamp"], loose[0]["label"], loose[0]["topic"]) == ("c", "2026-01-01T05:00:00Z", "Valid", "umum")
    strict = feed.flatten(df, strict=True).first()
    assert (strict["source"], strict["timestamp"]) == ("telegram-messages", "")


def test_feed_table(spark, tmp_path):
    name = "feed_table_test"
    feed.ensure_table(spark, name, str(tmp_path / "feed"))
    feed.ensure_table(spark, name)
    rows = lambda *ids: spark.createDataFrame(
        [(i, f"t{n}", "s", "RSS" if n % 2 else "Telegram", f"<b>{i}</b>", "Valid", 1.0, "u", "") for n, i in enumerate(ids)],
        "id string, timestamp string, source string, source_type string, text_snippet string, label string, confidence double, topic string, url string",
    )
    feed.insert_ignore(rows("a", "a", "b"), name)
    feed.insert_ignore(rows("b", "c", "a"), name)
    feed.insert_ignore(rows("b", "c", "a"), name)
    assert sorted((r["id"], r["timestamp"]) for r in spark.table(name).collect()) == [("a", "t0"), ("b", "t2"), ("c", "t1")]
    assert feed.reclean_table(spark, name) == 3
    assert sorted(r["text_snippet"] for r in spark.table(name).collect()) == ["a", "b", "c"]
    assert feed.purge(spark, name, F.col("source_type") == "RSS") == 1
    assert sorted(r["id"] for r in spark.table(name).collect()) == ["a", "b"]
    spark.sql(f"DROP TABLE {name}")


def test_dashboard_of_nothing(spark):
    empty = spark.createDataFrame([], schemas.LIVE_FEED)
    row = dash.snapshot(empty).first()
    assert row["total_messages_today"] == 0 and row["hoax_vs_valid_percent"]["valid"] == 0.0
    assert [tuple(p) for p in row["hourly_volume"]] == [("00", 0)]
    assert [tuple(p) for p in row["risk_scatter"]] == [("None", 0)]
    assert [tuple(r) for r in dash.hourly_volume(empty).collect()] == [("00", 0)]
    assert [tuple(r) for r in dash.risk_sources(empty).collect()] == [("None", 0)]


def test_snapshot_reads_the_feed_once(spark, tmp_path):
    path = str(tmp_path / "feed")
    spark.range(1000).select(
        F.concat(F.lit("s"), F.col("id") % 7).alias("source"), F.lit("Hoaks").alias("label"), F.lit("2026-01-01T05:00:00Z").alias("timestamp")
    ).write.parquet(path)
    df = dash.snapshot(spark.read.parquet(path))
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("ReusedExchange") >= 2


def test_latest_bounds(spark):
    with pytest.raises(ValueError):
        feed.latest(spark.createDataFrame([], schemas.LIVE_FEED), 101)


def test_search_blank_keeps_all(spark):
    df = spark.createDataFrame([("A b",), (None,)], "x string")
    assert feed.search(df, "  ", ["x"]).count() == 2
    assert feed.search(df, " a B ", ["x"]).count() == 1


def change(op, id, seq, fields=(), **row):
    r = {f: None for f in registry.FIELDS} | row
    return (op, id, seq, list(fields), tuple(r[f] for f in registry.FIELDS), f"t{seq}")


def test_registry_folding(spark):
    snap = spark.createDataFrame(
        [("a", "phone_number", "0811", "Budi", "s", 3, "active", "n", "c", "u"), ("b", "bank_account", "1", "X", "s", 1, "active", "n", "c", "u")],
        schemas.SCAM_RECORD,
    )
    log = spark.createDataFrame(
        [
            change("update", "a", 1, ["notes"], notes=None, owner_name="not set"),
            change("update", "a", 2, ["report_count"], report_count=9),
            change("delete", "b", 3), change("update", "b", 4, ["notes"], notes="late"),
            change("create", "c", 5, ["owner_name"], owner_name="New"), change("update", "c", 6, ["status"], status="resolved"),
            change("update", "d", 7, ["notes"], notes="x"), change("delete", "e", 8),
            change("create", "f", 9, ["owner_name"], owner_name="1"), change("delete", "f", 10), change("create", "f", 11, ["owner_name"], owner_name="2"),
        ],
        schemas.REGISTRY_CHANGE,
    )
    got = {r["id"]: r for r in registry.apply_changes(snap, log).collect()}
    assert set(got) == {"a", "c", "f"}
    a, c, f = got["a"], got["c"], got["f"]
    assert (a["owner_name"], a["notes"], a["report_count"], a["updated_at"], a["created_at"]) == ("Budi", None, 9, "t2", "c")
    assert (c["owner_name"], c["report_count"], c["status"], c["created_at"]) == ("New", 1, "resolved", "t5")
    assert (f["owner_name"], f["created_at"]) == ("2", "t11")
    for chunk in (1, 3, 100):
        bad = sorted((r["id"], r["seq"]) for r in registry.rejected(snap, log, chunk).collect())
        assert bad == [("b", 4), ("d", 7), ("e", 8)]


def test_registry_checks(spark):
    row = lambda v: ("i", "phone_number", v, "Budi", "src", 1, "active", None, "c", "u")
    df = spark.createDataFrame([row("1234"), row("12345"), row("x" * 65), row(None)], schemas.SCAM_RECORD)
    ok, bad = quality.split_valid(df, quality.scam_record_rules())
    assert [r["identifier_value"] for r in ok.collect()] == ["12345"]
    assert [r["reasons"] for r in bad.collect()] == [["identifier_value"]] * 3


def test_assert_classes_fails(spark):
    with pytest.raises(Exception, match="classes found"):
        quality.assert_classes(spark.createDataFrame([("Valid",)], "final_label string")).collect()


def test_chat_and_backfill(spark):
    df = spark.createDataFrame(
        [("c", None, "a", 1), ("c", "0", " ", 3), ("c", "5", "b", 2), ("d", "7", "x", 1)],
        "channel_name string, sender_id string, message string, s bigint",
    ).withColumn("sent", F.timestamp_seconds("s"))
    assert {(r["channel_name"], r["sender_id"]) for r in ingest.normalize_chat(df).collect()} == {("c", "unknown"), ("c", "5"), ("d", "7")}
    assert {r["message"] for r in ingest.backfill(df, n=2).collect()} == {"b", "x"}


def test_articles(spark):
    page = '{"data":{"data":[{"title":"a","body_text":"","body_html":"<p>h</p>","tags":["x"]},{"title":"b","body":"pl<b>ain</b>","category":"c"}]}}'
    df = spark.createDataFrame([(page,), ('{"data":[{"title":"d","body_text":"t"}]}',), ("no",), ('{"data":5}',)], "value string")
    got = {r["title"]: (r["body_text"], r["category"]) for r in ingest.hoax_article(ingest.flatten_pages(df)).collect()}
    assert got == {"a": ("h", "Klarifikasi Hoaks"), "b": ("pl ain", "c"), "d": ("t", "Klarifikasi Hoaks")}
    html = "<article><h2><a class='k' href='/x'> T <i>u</i></a></h2><time datetime='2026'>k</time><p> e </p></article><article><h3></h3></article>"
    row = ingest.listing_articles(spark.createDataFrame([(html,)], "html string")).collect()
    assert [(r["title"], r["link"], r["date"], r["excerpt"], r["label"]) for r in row] == [("Tu", "/x", "2026", "e", "hoax")]


def test_resume_summary(spark):
    df = spark.createDataFrame([("a", "PENIPUAN"), ("b", "ERROR"), ("c", "penipuan")], "filename string, kategori string")
    done = spark.createDataFrame([("c",)], "filename string")
    assert tuple(curate.run_summary(df, done, "filename").first()) == (3, 1, 1, 2)
    assert curate.pick_column(spark.createDataFrame([("a", "b")], "x string, judul string")) == "judul"


def test_no_cross_joins(spark):
    """Dashboard plans hold no nested-loop or Cartesian join."""
    df = spark.createDataFrame([], schemas.LIVE_FEED)
    for q in (dash.hourly_volume(df), dash.risk_sources(df), dash.snapshot(df), dash.label_counts(df)):
        plan = q._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def feed_rows(spark, *ids, kind="RSS"):
    return spark.createDataFrame(
        [(i, "t", "s", kind, f"<b>{i}</b>", "Valid", 1.0, "u", "") for i in ids],
        "id string, timestamp string, source string, source_type string, text_snippet string, label string, confidence double, topic string, url string",
    )


def test_rows_that_come_while_the_table_changes_are_not_lost(spark, tmp_path, monkeypatch):
    name = "feed_table_race"
    feed.ensure_table(spark, name, str(tmp_path / "feed"))
    stamp = lambda *ids, kind="RSS": feed_rows(spark, *ids, kind=kind).withColumn("inserted_at", F.current_timestamp()).select(*schemas.LIVE_FEED.names)
    feed.insert_ignore(feed_rows(spark, "a", "b"), name)
    feed.insert_ignore(feed_rows(spark, "c", kind="Telegram"), name)
    listed, old = files.leaves, feed._location(spark, name)
    calls = []

    def leaves(session, path):
        out = listed(session, path)
        calls.append(path)
        if len(calls) == 1:  # after the first listing another writer appends
            stamp("d", kind="Telegram").union(stamp("e")).write.mode("append").parquet(old)
        return out

    monkeypatch.setattr(files, "leaves", leaves)
    assert feed.purge(spark, name, F.col("source_type") == "RSS") == 3
    ids = lambda: sorted(r["id"] for r in spark.table(name).collect())
    assert ids() == ["c", "d"]
    stamp("f").write.mode("append").parquet(old)  # and one that had not heard of the move
    feed.insert_ignore(feed_rows(spark, "f", "g"), name)
    spark.catalog.refreshTable(name)
    assert ids() == ["c", "d", "f", "g"]
    (tmp_path / "gone").mkdir()
    assert feed.reclean_table(spark, name) == 4 and ids() == ["c", "d", "f", "g"]
    spark.sql(f"DROP TABLE {name}")


def test_empty_feed_table_can_be_purged(spark, tmp_path):
    feed.ensure_table(spark, "feed_table_empty", str(tmp_path / "feed"))
    assert feed.purge(spark, "feed_table_empty", F.lit(True)) == 0 and spark.table("feed_table_empty").count() == 0
    feed.insert_ignore(feed_rows(spark, "a"), "feed_table_empty")
    assert spark.table("feed_table_empty").count() == 1
    spark.sql("DROP TABLE feed_table_empty")


def test_few_ids_are_looked_up_in_bloom_filters(spark, tmp_path):
    name = "feed_table_bloom"
    feed.ensure_table(spark, name, str(tmp_path / "feed"))
    for k in range(6):
        feed.insert_ignore(feed_rows(spark, *[f"id-{(i * 7919) % 100003}-{k}" for i in range(500)]).coalesce(1), name)
    wanted = feed_rows(spark, "id-7919-2", "id-0-2", "nowhere")
    seen = feed.seen_ids(wanted, spark.table(name))
    assert sorted(r["id"] for r in seen.collect()) == ["id-0-2", "id-7919-2"]
    leaf = seen._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() <= 1000  # of 3000: the other files are ruled out
    assert feed.purge(spark, name, F.col("id") == "id-0-2") == 1
    assert [r["id"] for r in feed.seen_ids(wanted, spark.table(name)).collect()] == ["id-7919-2"]
    spark.sql(f"DROP TABLE {name}")


def test_many_ids_are_joined(spark, monkeypatch):
    monkeypatch.setattr(feed, "LOOKED_UP", 2)
    table = feed_rows(spark, "a", "b", "c")
    for rows, new in ((feed_rows(spark, "b", "c", "d", "e"), ["d", "e"]), (feed_rows(spark, "a"), [])):
        assert sorted(r["id"] for r in feed.new_rows(rows, table).collect()) == new
        assert sorted(r["id"] for r in feed.new_rows(rows, table, seen=feed.seen_ids(rows, table)).collect()) == new
