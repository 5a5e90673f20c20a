"""Terms counted as numbers on Arrow batches, and the similarity search that uses them."""

import random
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veristream.functions import grams
from veristream.operators import features, similarity

TEXTS = ["satu dua a satu dua", None, "", "a", "dua satu", "satu dua a satu dua", "tiga", "  dua   é éé tiga "]
COPIES = [1, 2, 1, 1, 3, 1, 1, 1]


def of(text):
    t = [w for w in (text or "").split(" ") if len(w) > 1]
    return t + [f"{a} {b}" for a, b in zip(t, t[1:])]


def stats(copies):
    total, df = Counter(), Counter()
    for text, n in zip(TEXTS, copies):
        for term, tf in Counter(of(text)).items():
            total[term] += n * tf
            df[term] += n
    return {t: (total[t], df[t]) for t in total}


@pytest.mark.parametrize("size,rows", [(8_000_000, 1 << 16), (12, 1 << 16), (1, 4), (100, 2)])
def test_counts_in_pieces(monkeypatch, size, rows):
    monkeypatch.setattr(grams, "PIECE_BYTES", size)
    monkeypatch.setattr(grams, "PIECE_ROWS", rows)
    batch = pa.RecordBatch.from_arrays([pa.array(COPIES, pa.int64()), pa.array(TEXTS, pa.string())], ["w", "t"])
    got = {}
    for out in grams.partial_stats([batch.slice(0, 3), batch.slice(3), batch.slice(0, 0)]):
        for r in out.to_pylist():
            a, b = got.get(r["term"], (0, 0))
            got[r["term"]] = (a + r["total"], b + r["df"])
    assert got == stats(COPIES)
    vocab = ["dua", "dua satu", "satu dua", "tak ada", "éé tiga", "x"]
    terms = grams.Terms(vocab, [-i for i in range(6)], [1.0, 2.0, 0.5, 1.0, 1.0, 1.0])
    seen = Counter()
    for out in terms.seen([batch.select([1])]):
        for r in out.to_pylist():
            seen[vocab[-r["place"]]] += r["seen"]
    assert seen == {t: sum(t in of(x) for x in TEXTS) for t in vocab if any(t in of(x) for x in TEXTS)}
    keyed = pa.RecordBatch.from_arrays([pa.array([bytes([i]) for i in range(8)], pa.binary()), batch.column(1)], ["k", "t"])
    rows_of = [r for out in terms.weigh([keyed]) for r in out.to_pylist()]
    assert [r["text_key"][0] for r in rows_of] == [0, 4, 5, 7]
    for r in rows_of:
        raw = {t: n * {"dua satu": 2.0, "satu dua": 0.5}.get(t, 1.0) for t, n in Counter(of(TEXTS[r["text_key"][0]])).items() if t in vocab}
        length = sum(x * x for x in raw.values()) ** 0.5
        assert {vocab[-p]: w for p, w in zip(r["places"], r["weights"])} == pytest.approx({t: x / length for t, x in raw.items()})


def test_occurrences_are_not_rows(spark):
    """a task hands on sums of its texts, not a row for each occurrence."""
    rows = [(i, t, c) for i, (t, c) in enumerate(zip(TEXTS, COPIES))]
    docs = spark.createDataFrame(rows, "id int, clean string, n int")
    found = features.term_stats(docs, "clean", "n")
    assert {r["term"]: (r["total"], r["df"]) for r in found.collect()} == stats(COPIES)
    assert "Generate" not in found._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("n,kinds", [(1, 4), (5, 4), (8, 30), (40, 30), (6, 500), (40, 500), (9000, 30)])
def test_top_terms_are_the_vocabulary(spark, n, kinds):
    """words tell which pairs can be among the first; ties at the last place, of few words or of many, lose none."""
    rng = random.Random(n + kinds)
    texts = [" ".join(f"w{int(kinds * rng.random() ** 2)}" for _ in range(rng.randint(0, 9))) for _ in range(40)]
    docs = spark.createDataFrame([(t,) for t in [*texts, "a b", "b1 a1", "b1 a1", "", None]], "clean string")
    want = features.vocabulary(features.term_stats(docs, "clean"), n).collect()
    assert features.top_terms(docs, "clean", n) == want
    assert features.top_terms(docs.limit(0), "clean", n) == []


def test_pairs_of_rare_words_are_not_counted(spark, monkeypatch):
    """the pairs that a task hands on are those of words which are common enough."""
    asked, count = [], features.term_stats

    def counting(*args, **which):
        asked.append(count(*args, **which))
        return asked[-1]

    monkeypatch.setattr(features, "term_stats", counting)
    rows = [(f"dan yang x{i} y{i} z{i} dan",) for i in range(50)]
    top = features.top_terms(spark.createDataFrame(rows, "clean string"), "clean", 2)
    assert [(r["term"], r["total"], r["df"]) for r in top] == [("dan", 100, 50), ("dan yang", 50, 50)]
    assert sum(df.count() for df in asked) == 152 + 1  # the words, and one pair: not 202 others


def test_vectors_equal_the_pipeline(spark, monkeypatch):
    """training finds words and pairs as numbers, without an array of them for each text."""
    monkeypatch.setattr(grams, "PIECE_ROWS", 4)
    rows = ["kata1 dan\tkata2\nlagi", "", "a", "kata1  dan kata1 dan", "é dan kata1ékata2 lagi", "tak dikenal", "dan kata1 x2"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "id int, text_clean string").coalesce(1)
    known = spark.createDataFrame([("kata1 dan kata2 dan kata1 lagi",), ("lagi dan",)], "text_clean string")
    vectorizer = features.fit_vectorizer(known, n_max=9)
    made = features.vectors(docs, vectorizer)
    assert "regexp_extract_all" not in made._jdf.queryExecution().optimizedPlan().toString()
    found = {r["id"]: r["features"] for r in made.collect()}
    want = {r["id"]: r["features"] for r in vectorizer.transform(docs).collect()}
    assert found.keys() == want.keys() and sum(v.numNonzeros() > 0 for v in want.values()) == 4
    for i, v in want.items():
        assert (found[i].size, list(found[i].indices)) == (v.size, list(v.indices))
        assert list(found[i].values) == pytest.approx(list(v.values), abs=1e-15)


def test_search_shuffles_texts_and_not_pairs(spark):
    """terms are not dealt anew for each query text, nor pairs looked up again."""
    c = spark.createDataFrame([(i, f"judul {i}", f"kata{i} kata{i % 7} dan lagi") for i in range(50)], "id bigint, title string, body_text string")
    index = similarity.build_index(c, texts=spark.createDataFrame([("kata1 dan",), ("dan",)], "_clean string"))
    seen = {r["term"]: r["place"] for r in index.vocabulary.collect()}
    assert seen["dan"] == 0 and seen["kata1"] == -1
    texts = spark.createDataFrame([(b"q", "kata1 dan"), (b"r", "kata2 kata2 lagi")], "text_key binary, _clean string")
    pairs = similarity.candidates(similarity._asked(texts, index.vocabulary, 3), index.postings, 0.05)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "hashpartitioning(text_key" in plan
    sizes = {r["n"] for r in pairs.groupBy("query_key").agg(F.count("*").alias("n")).collect()}
    assert sizes and min(sizes) > 0
