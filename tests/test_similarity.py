"""Similarity against a brute-force cosine, copies included."""

import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from veristream import fixed_values as fv
from veristream.operators import features, similarity


def grams(text):
    t = [w for w in text.split() if len(w) > 1]
    return t + [f"{a} {b}" for a, b in zip(t, t[1:])]


def brute(corpus, queries, k, threshold, n_terms):
    tf = {i: Counter(grams(t)) for i, t in corpus.items()}
    total, df = Counter(), Counter()
    for c in tf.values():
        total.update(c)
        df.update(c.keys())
    vocab = sorted(total, key=lambda w: (-total[w], w))[:n_terms]
    idf = {w: math.log((1 + len(corpus)) / (1 + df[w])) + 1 for w in vocab}

    def unit(counts):
        v = {w: n * idf[w] for w, n in counts.items() if w in idf}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()} if size else {}

    vectors = {i: unit(c) for i, c in tf.items()}
    out = {}
    for q, text in queries.items():
        v = unit(Counter(grams(text)))
        sims = [(sum(x * c.get(w, 0) for w, x in v.items()), i) for i, c in vectors.items()]
        sims = sorted((-round(s, 9), i) for s, i in sims if round(s, 9) >= threshold)
        for rank, (s, i) in enumerate(sims[:k], 1):
            out[q, rank] = (i, round(-s, 4))
    return out


@pytest.mark.parametrize("threshold,k,n_terms", [(0.5, 1, 20000), (0.2, 3, 20000), (0.05, 4, 60)])
def test_topk_equals_brute_force(spark, threshold, k, n_terms):
    rng = random.Random(5)
    words = ["dan", "yang", "ini"] * 6 + [f"kata{i}" for i in range(60)]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(3, 25)))
    corpus = {i: text() for i in range(30)}
    corpus.update({100 + i: corpus[3] for i in range(15)})  # a third are copies
    queries = {i: text() for i in range(60)}
    queries.update({200 + i: corpus[rng.randrange(30)] + " " + text() for i in range(30)})
    queries.update({400 + i: queries[205] for i in range(40)})
    queries[999] = "entah 1"
    c = spark.createDataFrame(list(corpus.items()), "id bigint, body_text string").withColumn("title", F.lit(None).cast("string"))
    q = spark.createDataFrame(list(queries.items()), "id bigint, text string")
    index = similarity.build_index(c, n_terms=n_terms)
    got = similarity.topk(q, index, k=k, threshold=threshold).collect()
    found = {(r["query_id"], r["rank"]): (r["article_id"], r["similarity"]) for r in got}
    want = brute(corpus, queries, k, threshold, n_terms)
    assert found.keys() == want.keys()
    for key, (article, sim) in want.items():
        assert found[key][0] == article and found[key][1] == pytest.approx(sim, abs=2e-4)


def test_reason_and_saved_index(spark, tmp_path):
    c = spark.createDataFrame([(1, "Listrik padam sembilan hari", "listrik padam global juli")], "id bigint, title string, body_text string")
    similarity.build_index(c, n_terms=7).save(str(tmp_path / "index"), 3)
    index = similarity.Index.load(spark, str(tmp_path / "index"))
    assert index.n_terms == 7 and index.postings.count() == 7
    q = spark.createDataFrame([(1, "listrik padam sembilan hari global"), (2, "cuaca cerah")], "id bigint, text string")
    rows = {r["id"]: r["reason"] for r in similarity.reason(q, similarity.topk(q, index)).collect()}
    assert rows[1].startswith("Mirip dengan hoaks terverifikasi Komdigi (") and rows[1].endswith('%): "Listrik padam sembilan hari"')
    assert rows[2] == fv.REASON_NONE


def test_long_and_vector_weights_agree(spark):
    rows = [(i, f"kata{i % 3} dan kata{i % 5} dan lagi") for i in range(12)]
    df = spark.createDataFrame(rows, "id bigint, text_clean string")
    long = {(r["id"], round(r["weight"], 9)) for r in features.tfidf(df, "id", "text_clean", 50).collect()}
    vectors = features.fit_vectorizer(df, n_max=50).transform(df).collect()
    assert {(r["id"], round(float(v), 9)) for r in vectors for v in r["features"].values} == long


@pytest.mark.parametrize("reorder", [True, False])
@pytest.mark.parametrize("threshold,k,n_terms", [(0.5, 1, 20000), (0.05, 4, 60)])
def test_saved_index_in_chunks_equals_brute_force(spark, tmp_path, monkeypatch, threshold, k, n_terms, reorder):
    monkeypatch.setattr(similarity, "CHUNK", 4)
    rng = random.Random(8)
    words = ["dan", "yang", "ini"] * 4 + [f"kata{i}" for i in range(40)]
    text = lambda: " ".join(rng.choice(words) for _ in range(rng.randint(1, 18)))
    corpus = {i: text() for i in range(40)} | {50: "dan yang", 51: "ini"}
    queries = {i: text() for i in range(60)} | {70: "dan yang", 71: "ini ini", 72: corpus[7], 73: "1 x"}
    c = spark.createDataFrame([(i, "", t) for i, t in corpus.items()], "id bigint, title string, body_text string")
    seen = Counter(g for t in queries.values() for g in set(grams(t)))
    background = spark.createDataFrame(list(seen.items()), "term string, df bigint")
    similarity.build_index(c, n_terms=n_terms, background=background).save(str(tmp_path / "i"), 4)
    q = spark.createDataFrame(list(queries.items()), "id bigint, text string")
    got = similarity.topk(q, similarity.Index.load(spark, str(tmp_path / "i")), k=k, threshold=threshold, reorder=reorder).collect()
    want = brute(corpus, queries, k, threshold, n_terms)
    found = {(r["query_id"], r["rank"]): (r["article_id"], r["similarity"]) for r in got}
    assert found.keys() == want.keys()
    assert all(found[key][0] == a and found[key][1] == pytest.approx(s, abs=2e-4) for key, (a, s) in want.items())


def test_saved_index_is_not_shuffled(spark, tmp_path):
    c = spark.createDataFrame([(i, "", f"kata{i} kata{i % 7} dan lagi") for i in range(50)], "id bigint, title string, body_text string")
    similarity.build_index(c).save(str(tmp_path / "i"), 4)
    index = similarity.Index.load(spark, str(tmp_path / "i"))
    asked = similarity._with_norms(similarity._counted(spark.createDataFrame([(b"q", ["kata1", "dan"])], "text_key binary, terms array<string>"), index.vocabulary), index.vocabulary)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = similarity.candidates(asked, index.postings, 0.5)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joins = [i for i, line in enumerate(plan.splitlines()) if "SortMergeJoin [place" in line and "chunk" in line]
    assert len(joins) == 1
    lines = plan.splitlines()[joins[0] + 1 :]
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    above = []  # what stands between the join and the index's scan
    now = depth(lines[scan])
    for line in reversed(lines[:scan]):
        if depth(line) < now:
            above.append(line)
            now = depth(line)
    assert above and not any("Exchange" in line for line in above)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="no test tables")
def test_few_pairs_are_candidates(spark, monkeypatch):
    """At most one pair in twenty of the given documents and passages."""
    from checks import tables as tb

    counted, find = [], similarity.candidates

    def count(asked, postings, threshold):
        out = find(asked, postings, threshold)
        texts = lambda df: df.select("text_key").distinct().count()
        counted.append((out.count(), texts(asked) * texts(postings)))
        return out

    monkeypatch.setattr(similarity, "candidates", count)
    index = similarity.build_index(tb.corpus(spark, "/root/testdata/sf0.1"), partitions=8)
    similarity.topk(tb.table(spark, "/root/testdata/sf0.1", "documents"), index, "doc_id", partitions=8)
    assert counted[0][0] <= 0.05 * counted[0][1]


def test_reason_in_the_stream_equals_the_batch(spark, tmp_path):
    import json

    from veristream.operators import enrich
    from veristream.sources import topics
    from veristream.streaming import jobs

    c = spark.createDataFrame([(1, "Listrik padam", "listrik padam global juli"), (2, "Air", "air laut naik besok")], "id bigint, title string, body_text string")
    index = similarity.build_index(c)
    texts = ["Listrik <b>padam</b> global", "cuaca cerah", "air laut naik", "air laut naik", "..."]
    (tmp_path / "in" / "telegram-messages").mkdir(parents=True)
    for i, t in enumerate(texts):
        (tmp_path / "in" / "telegram-messages" / f"{i}.txt").write_text(json.dumps({"message": t}) + "\n")
    out = str(tmp_path / "out")
    for _ in range(2):  # the second run finds nothing new
        stream = topics.read_topics(spark, folder=str(tmp_path / "in"), files_per_trigger=2)
        jobs.run_enrich(stream, "analyzed-news", str(tmp_path / "ck"), index=index, folder=out).awaitTermination()
    read = topics.read_topics_bounded(spark, ["analyzed-news"], folder=f"{out}/analyzed-news")
    got = sorted((json.loads(r["original_data"])["message"], r["analysis"]["reason"]) for r in enrich.parse_envelope(read).collect())
    q = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    want = sorted((r["text"], r["reason"]) for r in similarity.reason(q, similarity.topk(q, index)).collect())
    assert [r for _, r in got] == [r for _, r in want] and sum(r != fv.REASON_NONE for _, r in got) == 3
