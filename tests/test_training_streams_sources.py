"""Model life cycle, feedback jobs, streams against batch, readers."""

import json
import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F, types as T

from veristream import schemas
from veristream.operators import enrich, evaluate, feedback, train
from veristream.plans.verdict import verdict
from veristream.sources import readers, topics, writers
from veristream.streaming import jobs

WORDS = {"Valid": "menteri laporan resmi", "Hoaks": "viral sebar heboh", "Penipuan": "transfer hadiah menang", "Netral": "cuaca pagi olahraga"}


def labelled(spark, n=40):
    rows = [(i, f"{w} nomor{i % 7} kata", k) for i in range(n) for k, w in WORDS.items()]
    return spark.createDataFrame(rows, "row_id bigint, text string, final_label string")


def test_model_life_cycle(spark, tmp_path):
    model = train.fit(train.prepare(labelled(spark)))
    got = evaluate.summary(train.predict(train.prepare(labelled(spark)), model)).first()
    assert got["accuracy"] == 1.0 and got["f1_weighted"] == 1.0
    assert train.load(spark, str(tmp_path / "none")) is None
    train.save(model, str(tmp_path / "m"))
    again = train.load(spark, str(tmp_path / "m"))
    text = spark.createDataFrame([("Transfer hadiah http://x.id menang",)], "text string")
    row = verdict(text, model=again).first()
    assert row["label"] == "Penipuan" and row["baseline_scores"]["Penipuan"] > 60
    assert sum(row["baseline_scores"]) == pytest.approx(100, abs=0.05)


def test_missing_classes_score_zero(spark):
    two = labelled(spark).filter("final_label in ('Valid', 'Hoaks')")
    row = train.score(two.limit(1), train.fit(train.prepare(two))).first()["base"]
    assert row["Penipuan"] == 0.0 and row["Netral"] == 0.0


def test_retrain_job(spark, tmp_path):
    log = tmp_path / "feedback"
    log.mkdir()
    lines = [{"text": "Undian baru", "correct_label": "Penipuan"}, {"text": "undian  baru", "correct_label": "Hoax"}, {"text": "x", "correct_label": "apa"}]
    (log / "a.jsonl").write_text("\n".join(map(json.dumps, lines)) + "\n\nrusak\n")
    where = {k: str(tmp_path / k) for k in ("model_path", "pool_path", "archive_path")}
    assert feedback.retrain(spark, str(log), labelled(spark), at_least=9, **where) is None
    assert feedback.retrain(spark, str(log), labelled(spark), **where) is not None
    pool = spark.read.parquet(where["pool_path"]).collect()
    assert [r["text"] for r in pool] == ["undian baru"]
    assert spark.read.text(where["archive_path"]).filter("value <> ''").count() == 4
    assert feedback.retrain(spark, str(log), labelled(spark), **where) is None  # emptied


def test_retrain_cleans_corrections_once(spark, tmp_path, monkeypatch):
    """training and pool share the cleaned corrections; the other reading looks whether there are enough."""
    log = tmp_path / "feedback"
    log.mkdir()
    lines = [{"text": t, "correct_label": k} for t, k in (("Undian baru", "Penipuan"), ("undian <b>BARU", "Hoax"), ("menteri laporan", "Netral"))]
    (log / "a.jsonl").write_text("\n".join(map(json.dumps, lines)))
    reads, read, seen = [], readers.read_jsonl, []
    monkeypatch.setattr(readers, "read_jsonl", lambda *args: reads.append(args) or read(*args))

    def fit(rows):
        seen.extend(sorted((r["text_clean"], r["label_num"]) for r in rows.collect()))
        return PipelineModel(stages=[])

    where = {k: str(tmp_path / k) for k in ("model_path", "pool_path", "archive_path")}
    original = spark.createDataFrame([("Menteri: laporan", "Valid")], "text string, final_label string")
    assert feedback.retrain(spark, str(log), original, **where, fit=fit) is not None
    assert len(reads) == 2
    assert seen == [("menteri laporan", 0), ("undian baru", 1)]
    pool = spark.read.parquet(where["pool_path"]).collect()
    assert sorted((r["text"], r["label_num"]) for r in pool) == [("menteri laporan", 3), ("undian baru", 1)]


def test_retrain_query_joins_labels_once(spark, tmp_path, monkeypatch):
    """the runs read labelled texts, and don't join all documents with their labels again."""
    from checks import queries

    spark.createDataFrame([(i, f"teks {i}", "s") for i in range(6)], "doc_id bigint, text string, source string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2, 0) for i in (1, 2, 2, 9)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    seen = []

    def stop(spark, log, original, *args, **kwargs):
        seen.append(original)
        raise RuntimeError("seen")

    monkeypatch.setattr(feedback, "retrain", stop)
    with pytest.raises(RuntimeError, match="seen"):
        queries.feedback_retrain(spark, str(tmp_path))
    assert sorted(map(tuple, seen[0].collect())) == [("teks 1", "Valid"), ("teks 2", "Netral"), ("teks 2", "Netral")]
    assert "Join" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()


def test_retrain_leaves_late_files(spark, tmp_path, monkeypatch):
    """A file that arrives during the training is neither archived nor deleted."""
    log = tmp_path / "feedback"
    log.mkdir()
    line = lambda text: json.dumps({"text": text, "correct_label": "Hoaks"}) + "\n"
    (log / "a.jsonl").write_text(line("kabar satu"))
    where = {k: str(tmp_path / k) for k in ("model_path", "pool_path", "archive_path")}
    fit = train.fit

    def slow(rows):
        (log / "b.jsonl").write_text(line("kabar dua"))
        return fit(rows)

    monkeypatch.setattr(train, "fit", slow)
    assert feedback.retrain(spark, str(log), labelled(spark), **where) is not None
    assert [f.name for f in log.glob("*.jsonl")] == ["b.jsonl"]
    assert [r["value"] for r in spark.read.text(where["archive_path"]).collect()] == [line("kabar satu").strip()]
    monkeypatch.setattr(train, "fit", fit)
    assert feedback.retrain(spark, str(log), labelled(spark), **where) is not None
    assert sorted(r["text"] for r in spark.read.parquet(where["pool_path"]).collect()) == ["kabar dua", "kabar satu"]


@pytest.mark.parametrize("step", ["claim", "train_on", "add_to_pool", "archive", "finish", "clear"])
@pytest.mark.parametrize("after", [False, True])
def test_a_broken_retraining_is_finished(spark, tmp_path, monkeypatch, step, after):
    """Killed before or after any step: the next call ends the run, and nothing is lost or there twice."""
    log = tmp_path / "feedback"
    log.mkdir()
    line = lambda text: json.dumps({"text": text, "correct_label": "Hoaks"}) + "\n"
    (log / "a.jsonl").write_text(line("kabar satu") + line("kabar dua"))
    where = {k: str(tmp_path / k) for k in ("model_path", "pool_path", "archive_path")}
    fit = lambda rows: PipelineModel(stages=[])  # what is trained doesn't matter here
    whole = getattr(feedback, step)

    def dies(*args):
        if after:
            whole(*args)
        raise RuntimeError("killed")

    monkeypatch.setattr(feedback, step, dies)
    with pytest.raises(RuntimeError):
        feedback.retrain(spark, str(log), labelled(spark), **where, fit=fit)
    monkeypatch.setattr(feedback, step, whole)
    (log / "b.jsonl").write_text(line("kabar dua") + line("kabar tiga"))
    for _ in range(2):
        feedback.retrain(spark, str(log), labelled(spark), **where, fit=fit)
    assert not list(log.glob("*.jsonl"))
    assert sorted(r["text"] for r in spark.read.parquet(where["pool_path"]).collect()) == ["kabar dua", "kabar satu", "kabar tiga"]
    lines = [r["value"] for r in spark.read.text(where["archive_path"]).collect()]
    assert sorted(lines) == sorted(line(t).strip() for t in ("kabar satu", "kabar dua", "kabar dua", "kabar tiga"))
    assert train.load(spark, where["model_path"]) is not None
    assert feedback.retrain(spark, str(log), labelled(spark), **where, fit=fit) is None


def test_feedback_trigger(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    calls = []

    def feed(name, n):
        (src / name).write_text("".join(json.dumps({"text": f"{name} {i}", "correct_label": "Hoaks"}) + "\n" for i in range(n)))
        q = jobs.feedback_trigger(jobs.feedback_lines(spark, str(src)), 5, lambda: calls.append(1), str(tmp_path / "pool"), str(tmp_path / "ck"))
        q.awaitTermination()
        return len(calls)

    assert [feed("a", 3), feed("b", 2), feed("c", 4), feed("d", 1)] == [0, 1, 1, 2]
    assert spark.read.parquet(str(tmp_path / "pool/rows")).count() == 10


def test_stream_equals_batch(spark, tmp_path):
    for topic, rows in {
        "rss-news": [{"title": "Sebarkan!", "description": "Viralkan <b>ini</b>", "link": "l1"}, {"title": "t", "description": ""}],
        "telegram-messages": [{"message": "hub 081299998888", "channel_name": "c"}], "ignored": [{"text": "no"}],
    }.items():
        (tmp_path / "in" / topic).mkdir(parents=True)
        (tmp_path / "in" / topic / "1.txt").write_text("\n".join(map(json.dumps, rows)) + "\nrusak\n")
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    stream = topics.read_topics(spark, folder=folder, files_per_trigger=1)
    jobs.run_enrich(stream, "analyzed-news", str(tmp_path / "ck"), folder=out).awaitTermination()
    jobs.run_enrich(stream, "analyzed-news", str(tmp_path / "ck"), folder=out).awaitTermination()  # nothing new
    got = enrich.parse_envelope(spark.read.text(f"{out}/analyzed-news"))
    want = jobs.enrich(topics.read_topics_bounded(spark, folder=folder))
    flat = lambda df: sorted((r["source_topic"], r["analysis"]["label"], r["analysis"]["score"]) for r in df.collect())
    assert flat(got) == flat(want) == [("rss-news", "Hoaks", 30.0), ("telegram-messages", "Valid", 0.0)]
    _, bad = jobs.split_bad(topics.read_topics_bounded(spark, folder=folder))
    assert sorted(r["reason"] for r in bad.collect()) == ["blank text", "not json", "not json"]


def test_enrich_plan_has_no_shuffle(spark, tmp_path):
    df = jobs.enrich(spark.createDataFrame([("t", "{}")], "topic string, value string"))
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()


def test_verdict_table_join(spark):
    m = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    v = spark.createDataFrame([(1, "Hoaks")], "id int, label string")
    assert {(r["id"], r["label"]) for r in enrich.with_verdict(m, v).collect()} == {(1, "Hoaks"), (2, None)}


def test_readers(spark, tmp_path):
    (tmp_path / "a.csv").write_text('Teks,label\n"baris satu\nbaris dua",1\nx,bukan\ny,2\n')
    got = readers.read_csv(spark, str(tmp_path / "a.csv"), T.StructType.fromDDL("Teks string, label int"))
    assert sorted(r["Teks"] for r in got.collect()) == ["baris satu\nbaris dua", "y"]
    (tmp_path / "empty.json").write_text("[]")
    assert readers.read_json_array(spark, str(tmp_path / "empty.json"), schemas.FACT_ARTICLE).count() == 0
    (tmp_path / "f.csv").write_text(",".join(schemas.FACT_ARTICLE_CSV_COLUMNS) + "\n")
    assert readers.read_glob(spark, str(tmp_path / "f.csv")).count() == 0
    first = readers.first_existing(spark, [str(tmp_path / "no"), str(tmp_path / "a.csv")], T.StructType.fromDDL("Teks string"), "csv", header=True)
    assert first.columns == ["Teks"]
    assert readers.first_existing(spark, [str(tmp_path / "no")], schemas.LABELED_TEXT).count() == 0
    (tmp_path / "r.xml").write_text(
        "<rss><channel><item><title>T</title><link>l</link><description>d</description><pubDate>p</pubDate></item>"
        "<item><link>m</link><summary>s</summary><description>d</description></item></channel></rss>"
    )
    assert {tuple(r) for r in readers.read_rss(spark, str(tmp_path / "r.xml")).collect()} == {("l", "T", "d", "p"), ("m", "", "s", "")}


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("é,\"x\"", 1)], "a string, b int")
    writers.export_csv(df, str(tmp_path / "c"), ["b", "a"])
    assert [tuple(r) for r in spark.read.csv(str(tmp_path / "c"), header=True, escape='"').collect()] == [("1", 'é,"x"')]
    writers.write_manifest(df, str(tmp_path / "m"), "s", "Hoaks")
    assert spark.read.schema(schemas.MANIFEST).json(str(tmp_path / "m")).first()["total_articles"] == 1
    log = verdict(spark.createDataFrame([("kiamat",)], "text string"))
    writers.append_log(log, str(tmp_path / "l"))
    writers.append_log(log, str(tmp_path / "l"))
    good, bad = readers.read_jsonl(spark, str(tmp_path / "l"), schemas.PREDICTION_LOG)
    assert good.count() == 2 and bad.count() == 0


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 0)], "label_num int, prediction int")
    assert {r["label"]: (r["p0"], r["p1"]) for r in evaluate.confusion(df).collect()} == {0: (1, 1), 1: (0, 1), 2: (1, 0)}
    rep = {r["label"]: r for r in evaluate.report(df).collect()}
    assert rep["2"]["precision"] == 0.0 and rep["2"]["recall"] == 0.0 and rep["weighted avg"]["support"] == 4
