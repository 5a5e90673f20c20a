"""Silver and gold: keep-first, exact class sizes, skew, repeatability."""

import hashlib
import math
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from veristream import fixed_values as fv, schemas
from veristream.operators import curate, sampling
from veristream.plans import medallion
from veristream.sources.lake import Lake


def skewed(spark, n=6000):
    """A third of all rows are copies of one text; one class holds most rows."""
    return spark.range(n).select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, F.lit("x" * 40)).otherwise(F.concat(F.lit("some longer text number "), (F.col("id") % 1999).cast("string"))).alias("text"),
        F.when(F.col("id") % 50 == 0, F.lit("Hoaks")).when(F.col("id") == 7, F.lit("Netral")).otherwise(F.lit("Valid")).alias("final_label"),
        F.lit("s").alias("source"),
    )


def test_dedup_keeps_first_under_skew(spark):
    rows = skewed(spark).collect()
    first = {}
    for r in sorted(rows, key=lambda r: r["id"]):
        first.setdefault(r["text"], r["id"])
    got = curate.dedup_keep_first(skewed(spark), ["text"], [F.col("id")])
    assert {r["text"]: r["id"] for r in got.collect()} == first
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[0].count("WindowGroupLimit") == 2  # one limit before the shuffle, one after


def test_dedup_null_is_one_key(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "")], "id int, text string")
    assert sorted(r["id"] for r in curate.dedup_keep_first(df, ["text"], ["id"]).collect()) == [1, 3]


def test_balance_exact_sizes(spark):
    df = skewed(spark)
    got = sampling.balance(df, 500, key="id").collect()
    assert Counter(r["final_label"] for r in got) == {"Valid": 500, "Hoaks": 500, "Netral": 500}
    big = [r["id"] for r in got if r["final_label"] == "Valid"]
    assert len(set(big)) == 500  # no copies where there are enough rows
    assert {r["id"] for r in got if r["final_label"] == "Netral"} == {7}


def test_balance_class_of_exact_size(spark):
    df = spark.range(20).select(F.col("id"), F.lit("Valid").alias("final_label"))
    assert sorted(r["id"] for r in sampling.balance(df, 20, key="id").collect()) == list(range(20))


def test_sampling_is_repeatable(spark):
    def run(partitions):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        df = skewed(spark).repartition(int(partitions) + 1)
        b = sorted(tuple(r) for r in sampling.balance(df, 100, key="id").select("id", "final_label").collect())
        s = sorted(tuple(r) for r in sampling.split(df, key="id").select("id", "part").collect())
        d = sorted(r["id"] for r in curate.dedup_keep_first(df, ["text"], ["id"]).collect())
        return b, s, d

    try:
        assert run("1") == run("8")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_split_shares(spark):
    got = sampling.split(skewed(spark), key="id").groupBy("final_label", "part").count().collect()
    n = {(r["final_label"], r["part"]): r["count"] for r in got}
    assert n["Hoaks", "test"] == 24 and n["Hoaks", "train"] == 96 and n["Netral", "test"] == 1


def test_positions_are_dense(spark):
    got = sampling.positions(skewed(spark), "final_label", "id", 1).select("final_label", "_pos", "_size").collect()
    by = {}
    for r in got:
        by.setdefault((r["final_label"], r["_size"]), []).append(r["_pos"])
    for (_, size), pos in by.items():
        assert sorted(pos) == list(range(1, size + 1))


def test_templates(spark):
    rows = curate.expand_templates(spark, 300).collect()
    assert Counter(r["label_raw"] for r in rows) == {"Penipuan": 300, "Netral": 300}
    assert not any("{" in r["text"] for r in rows)
    bro = [r["text"] for r in rows if r["text"].startswith("Bro, ini aku")]
    assert bro
    for text in bro:
        one = text.split("ini aku ")[1].split(".")[0]
        assert one in fv.NAMES and f"a/n {one}?" not in text
    assert rows == curate.expand_templates(spark, 300).collect()


def test_medallion(spark, tmp_path):
    lake = Lake(str(tmp_path))
    raw = medallion.raw_sources(spark, str(tmp_path / "none"), 40)
    raw["kaggle"] = spark.createDataFrame(
        [(None, "cukup panjang untuk lolos saringan tiga puluh", "1.0", "k"), ("pendek", None, "0", "k"),
         ("berita panjang yang benar benar terjadi di kota", "x", "nan", "k")],
        "text_new string, FullText string, hoax string, source string",
    )
    medallion.build_bronze(spark, lake, raw)
    silver = medallion.build_silver(spark, lake)
    kaggle = {r["text"]: r["final_label"] for r in silver.filter("source = 'k'").collect()}
    assert kaggle == {
        "cukup panjang untuk lolos saringan tiga puluh": "Hoaks",
        "berita panjang yang benar benar terjadi di kota": "Valid",
    }
    gold = medallion.build_gold(spark, lake, 25, csv_path=str(tmp_path / "csv"))
    assert {r["final_label"]: r["count"] for r in gold.groupBy("final_label").count().collect()} == {
        "Penipuan": 25, "Netral": 25, "Hoaks": 25, "Valid": 25,
    }
    assert gold.columns == schemas.LABELED_TEXT.names
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 100


@pytest.mark.parametrize("small", [5, 20_000])
def test_split_compares_with_the_exact_hash(spark, monkeypatch, small):
    """Few hashes a bucket make the histogram go down to the end; a frequent key is one hash."""
    monkeypatch.setattr(sampling, "SMALL", small)
    rows = [(str(i) if i % 4 else None, ["a", "a", "a", "b", None][i % 5], "t" * 50) for i in range(600)]
    df = spark.createDataFrame(rows, "id string, final_label string, text string").repartition(3)
    parts = [("x", "0"), ("y", "0.1"), ("z", "0.33"), ("rest", "0.57")]
    out = sampling.split(df, parts, key="id")
    got = sorted(((r["id"], r["final_label"], r["part"]) for r in out.collect()), key=str)
    want = []
    for label in ("a", "b", None):
        mine = sorted((hashlib.md5(f"{i or ''}:42".encode()).hexdigest(), str(i), i) for i, la, _ in rows if la == label)
        first = {}
        for k, (h, _, i) in enumerate(mine, 1):
            k = first.setdefault(h, k)
            want.append((i, label, "y" if k <= math.ceil(Decimal("0.1") * len(mine)) else "z" if k <= math.ceil(Decimal("0.43") * len(mine)) else "rest"))
    assert got == sorted(want, key=str)
    assert "Exchange hashpartitioning" not in out._jdf.queryExecution().executedPlan().toString()
    assert "Exchange range" not in out._jdf.queryExecution().executedPlan().toString()


def test_balance_of_one_frequent_key(spark):
    df = spark.createDataFrame([("same", "a", str(i)) for i in range(300)] + [(str(i), "b", "t") for i in range(30)], "id string, final_label string, text string")
    counts = {r["final_label"]: r["count"] for r in sampling.balance(df, 100, key="id").groupBy("final_label").count().collect()}
    assert counts == {"a": 100, "b": 100}
