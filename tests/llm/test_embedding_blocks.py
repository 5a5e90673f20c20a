"""Near copies among embeddings: vectors are written once, blocks meet without a shuffle, and no link is lost between them."""

import numpy as np
import pytest

from pyspark.sql import functions as F

from veristream.llm import embedding_dedup


def vectors(n=1500, dims=16, seed=5):
    """No clusters but for near copies, a chain of them, exact and scaled copies; ids repeat, some are null."""
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dims))
    x[: n // 5] = x[n // 5 : 2 * (n // 5)] + 0.3 * r.normal(size=(n // 5, dims))
    turn = np.linspace(0, np.pi, 40)
    x[-40:] = np.cos(turn)[:, None] * x[-41] / np.linalg.norm(x[-41]) + np.sin(turn)[:, None] * np.eye(dims)[0]
    x[-60:-50] = x[-61]
    x[-50:-45] = 2 * x[-61]
    x = x.astype(np.float32).astype(np.float64)
    ids = [int(i) for i in r.permutation(n)]
    ids[3:9] = [7, 7, 7, None, None, -2]
    return ids, x


def brute(ids, x):
    """(id, links, component) of every row."""
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    known = np.array([i is not None for i in ids])
    linked = (unit @ unit.T >= 0.9) & known & known[:, None]
    least = np.array([i if i is not None else 2**40 for i in ids])
    while True:
        before = least
        least = np.where(linked, least, 2**40).min(1, initial=2**40)
        least = np.where(known, np.minimum(least, before), before)
        if (least == before).all():
            break
    return sorted(((i, int(linked[k].sum()) - 1, int(least[k])) if known[k] else (None, 0, None) for k, i in enumerate(ids)), key=str)


@pytest.mark.parametrize("kind, more", [("float", {}), ("double", {"cell": 40})])
def test_vectors_are_written_once(spark, monkeypatch, kind, more):
    made, plans, write = {}, {}, embedding_dedup.materialize

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        made[name] = write(df, name)
        return made[name]

    monkeypatch.setattr(embedding_dedup, "materialize", watched)
    monkeypatch.setattr(embedding_dedup, "BLOCK", 100)  # many blocks of few vectors
    ids, x = vectors()
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in zip(ids, x)], f"vec_id long, embedding array<{kind}>, label int").repartition(5)
    out = embedding_dedup.groups(df, **more).collect()
    assert sorted(((r["vec_id"], r["n_links"], r["component_id"]) for r in out), key=str) == brute(ids, x)
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in out)
    for name, t in made.items():  # nothing is sent to the cells it visits
        size = [F.sum(F.length(c)) for c, k in t.dtypes if k == "binary"] or [F.lit(0)]
        assert sum(t.select(*size).first()) <= len(x) * (16 * 8 + 64), name
    assert "Exchange" not in plans["links"] and "CartesianProduct" in plans["links"]


@pytest.mark.parametrize("dims", [1, 3, 16, 64])
def test_blocks_meet_like_brute_force(monkeypatch, dims):
    monkeypatch.setattr(embedding_dedup, "TILE", 37)
    monkeypatch.setattr(embedding_dedup, "FOLD", 20)
    r = np.random.default_rng(dims)
    x = r.normal(size=(400, dims))
    x[300:] = x[:100] + r.uniform(0, 0.6, 100)[:, None] * np.linalg.norm(x[:100], axis=1)[:, None] * r.normal(size=(100, dims)) / np.sqrt(dims)
    x[200:260] = x[200] + 0.05 * r.normal(size=(60, dims))
    x = embedding_dedup._units(x.tobytes(), dims, 8)
    centroids = embedding_dedup.fit_cells(x, 6)
    cells = {dims: (centroids, *embedding_dedup.fit_turn(x, 0.9))}
    home = (x @ centroids.T).argmax(1)
    order = np.lexsort((np.arange(400), home))
    copies = r.integers(1, 4, 400)

    def block(at):
        columns = {"cell": home[at].astype(np.int32), "rep": at.astype(np.int64), "least": 1000 - at, "copies": copies[at], "raw": x[at]}
        return embedding_dedup._Block({"dim": dims} | {c: v.tobytes() for c, v in columns.items()}, cells, 8)

    blocks = [block(order[:150]), block(order[150:310]), block(order[310:])]
    gain, root = np.zeros(400, np.int64), np.arange(400)
    for i, a in enumerate(blocks):
        for b in blocks[i:]:
            rep, least, more, of = embedding_dedup._meet(a, b, 0.9, embedding_dedup.safe_margin(0.9))
            assert (least == 1000 - rep).all()
            np.add.at(gain, rep, more)
            root = embedding_dedup._roots(400, np.concatenate([np.arange(400), rep]), np.concatenate([root, of]))
    linked = x @ x.T >= 0.9
    assert (gain == linked @ copies - copies).all()
    assert (root == embedding_dedup._roots(400, *np.nonzero(linked))).all()


def test_leading_directions_bound_cosines():
    r = np.random.default_rng(2)
    x = r.normal(size=(600, 64)) * np.r_[np.ones(8) * 3, np.ones(56)]
    x /= np.linalg.norm(x, axis=1)[:, None]
    turn, lead = embedding_dedup.fit_turn(x, 0.9)
    assert 0 < lead < 64
    y = embedding_dedup._lead(x, turn, lead)
    assert (y @ y.T >= x @ x.T - 1e-5).all()
    i, j = embedding_dedup._near(y, y, x, x, 0.9)
    assert set(zip(i, j)) == set(zip(*np.nonzero(x @ x.T >= 0.9)))
