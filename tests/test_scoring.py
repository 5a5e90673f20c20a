"""The fusion rules branch by branch, golden texts, and messages."""

import pytest
from pyspark.sql import Row, functions as F

from veristream import fixed_values as fv
from veristream.functions import scoring
from veristream.plans.verdict import verdict

S = "struct<Valid:double,Hoaks:double,Penipuan:double,Netral:double>"


# text, scores of the base model, scores of the deep one (Valid, Hoaks, Penipuan, Netral); label and scores expected
CASES = [
    ("biasa", (10, 20, 30, 40), (0, 0, 55, 0), "Penipuan", [10, 20, 55, 40]),
    ("biasa", (10, 20, 30, 40), (1, 2, 55.1, 3), "Penipuan", [1, 6, 55.1, 8]),
    ("SEBARKAN ini", (10, 5, 30, 40), None, "Netral", [10, 35, 30, 40]),
    ("sebarkan", (10, 5.1, 30, 40), None, "Hoaks", [2, 35.1, 9, 8]),
    ("biasa", (1, 55, 2, 3), (9, 9, 9, 9), "Hoaks", [9, 55, 9, 9]),
    ("biasa", (1, 55.5, 2, 3), (9, 9, 10, 9), "Hoaks", [1, 55.5, 3, 0.6]),
    ("resmi", (95, 1, 2, 3), None, "Valid", [100, 1, 2, 3]),
    ("kiamat", (0, 90, 0, 0), None, "Hoaks", [0, 100, 0, 0]),
    ("biasa", (0, 0, 0, 0), None, "Valid", [0, 0, 0, 0]),
    ("biasa", (5, 5, 5, 5), (5, 5, 5, 5), "Valid", [5, 5, 5, 5]),
    ("biasa", (1, 1, 7, 7), None, "Penipuan", [1, 1, 7, 7]),
    ("biasa", (1, 2, 3, 4), (4, 3, 2, 1), "Valid", [4, 3, 3, 4]),
]


def test_fusion_branches(spark):
    rows = [(i, t, tuple(map(float, b)), tuple(map(float, d)) if d else None) for i, (t, b, d, _, _) in enumerate(CASES)]
    df = spark.createDataFrame(rows, f"i int, text string, base {S}, deep {S}")
    for row in scoring.fuse(df).collect():
        label, s = CASES[row["i"]][3:]
        assert row["label"] == label, CASES[row["i"]]
        assert list(row["all_scores"]) == pytest.approx(s), CASES[row["i"]]
        assert row["score"] == pytest.approx(s[fv.LABELS.index(label)])


GOLDEN = [
    ("Akan ada pemadaman listrik global! Sebarkan sebelum dihapus pemerintah!", "Hoaks", 30.0),
    ("Bank Indonesia melaporkan pertumbuhan ekonomi berdasarkan data resmi BPS.", "Valid", 8.0),
    ("Halo, hari ini cuaca cerah cocok untuk olahraga pagi.", "Valid", 0.0),
]


@pytest.mark.parametrize("text,label,score", GOLDEN)
def test_golden_without_model(spark, text, label, score):
    row = verdict(spark.createDataFrame([(text,)], "text string")).first()
    assert (row["label"], row["score"]) == (label, score)
    assert row["recommendation"] == fv.RECOMMENDATIONS[label]


def test_render(spark):
    text = "Transfer ke rekening 1234567890 BCA"
    df = verdict(
        spark.createDataFrame([(text,)], "text string").withColumn("deep", scoring.scores(1.2, 3.4, 92.1, 3.3))
    )
    row = scoring.render(df).first()
    assert row["label"] == "Penipuan"
    assert row["rendered"].split("\n")[:5] == [
        "🚨 HASIL DETEKSI: PENIPUAN", "Skor keyakinan: 92.1%", "", "Rincian skor tiap kelas:", "  - Valid: 1.2%",
    ]
    assert "\n\nEntitas mencurigakan terdeteksi:\n  Nomor Rekening: 1234567890\n\nAlasan / Rekomendasi:\n" in row["rendered"]


def test_indicator_rule(one):
    rule = one(scoring.indicator_rule, "Klik bit.ly/x untuk verifikasi")
    assert rule["indicators"] == ["klik", "bit.ly", "verifikasi"]
    assert (rule["classification"], rule["confidence"]) == ("Scam", 96.4)
    assert one(scoring.indicator_rule, "klik saja")["classification"] == "Review"


def test_percent_guard(spark):
    df = spark.createDataFrame([Row(a=0, b=0), Row(a=1, b=3)])
    assert [r[0] for r in df.select(scoring.pct(F.col("a"), F.col("b"))).collect()] == [0.0, 33.33]
