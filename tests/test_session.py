from veristream import session


def test_scratch_folder(spark, monkeypatch, tmp_path):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            assert key == "spark.checkpoint.dir"
            return self.value

    class Fake:
        sparkContext = spark.sparkContext

        def __init__(self, value):
            self.conf = Conf(value)

    assert session.scratch_root(Fake("/shared/x/")) == "/shared/x"
    own = session.scratch_root(Fake(None))
    assert own == session.scratch_root(Fake(None))
    assert session.scratch_path(Fake(None), "a") != session.scratch_path(Fake(None), "a")


def test_materialize_and_spread(spark):
    df = spark.range(10).coalesce(1)
    assert session.materialize(df, "t").count() == 10
    assert session.spread(df).rdd.getNumPartitions() == 1
    assert session.spread(df, 5).rdd.getNumPartitions() == 5


def test_tasks_grow_with_the_texts(spark, monkeypatch):
    from veristream.operators import features

    monkeypatch.setattr(session, "TASK_CHARS", 100)
    df = spark.createDataFrame([(i, f"one two w{i} w{i % 7}") for i in range(60)] + [(60, None)], "id long, clean string")
    n = session.tasks_for(df, "clean", 2)
    assert n > 8 and session.tasks_for(df.limit(0), "clean", 2) == 2
    dealt = features.tfidf(df, "id", "clean", partitions=n)
    # documents are dealt to as many tasks, which adaptive execution leaves alone
    assert f", {n}), REPARTITION_BY_NUM" in dealt._jdf.queryExecution().toString()
    rounded = lambda rows: sorted((r["id"], r["term"], round(r["weight"], 9)) for r in rows.collect())
    assert rounded(dealt) == rounded(features.tfidf(df, "id", "clean"))
