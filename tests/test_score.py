"""Scores by numbers against the saved pipeline's own."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from veristream.operators import train


def test_scores_equal_the_pipeline(spark, tmp_path):
    """texts are scored without an array of their words and pairs."""
    rows = [(f"kata{i % 5} dan kata{i % 3} lagi x{i % 4}", i % 4) for i in range(40)]
    fitted = train.fit(spark.createDataFrame(rows, "text_clean string, label_num int"), n_max=12, max_iter=20)
    train.save(fitted, str(tmp_path / "m"))
    model = train.load(spark, str(tmp_path / "m"))
    texts = ["kata1 dan\tkata2\nlagi", "", "a", "kata1  dan kata1 dan", "é dan kata1ékata2 lagi", "tak dikenal", "kata4 dan kata1 x2"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text_clean string")
    got = train.probabilities(df, model)
    assert got.columns == ["id", "text_clean", "_p"]
    assert "ArrowEvalPython" in got._jdf.queryExecution().optimizedPlan().toString()
    found = {r["id"]: r["_p"] for r in got.collect()}
    want = {r["id"]: r["p"] for r in model.transform(df).select("id", vector_to_array("probability").alias("p")).collect()}
    assert found.keys() == want.keys()
    assert all(found[i] == pytest.approx(want[i], abs=1e-12) for i in want)
    assert train.score(df.select("id", F.col("text_clean").alias("text")), model).columns == ["id", "text", "base"]
