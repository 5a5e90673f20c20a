"""Rows that share an id with unlike content are documents, and vectors, of their own."""

import random

import numpy as np

from veristream.llm import embedding_dedup, jaccard_join

DDL = "doc_id long, text string, source string, least long, _jj_n long"


def test_unlike_texts_of_one_id_all_stay(spark):
    r = random.Random(3)
    text = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(6)) for _ in range(60))
    one, two, three = text(), text(), text()
    near = two.rsplit(" ", 2)[0] + " other words"
    rows = [(1, one, "a"), (1, two, "b"), (2, near, "c"), (3, three, "d"), (3, three, "e"), (4, one, "f"), (5, None, "g"), (5, "", "h"), (6, "", "i"), (None, one, "j"), (7, "x y", "k"), (7, "x z", "l")]
    df = spark.createDataFrame([(*x, 1, 2) for x in rows], DDL).repartition(3)
    out = jaccard_join.keep(df)
    assert out.columns == df.columns
    got = sorted(((x["doc_id"], x["text"]) for x in out.collect()), key=str)
    # one of the two empty rows of id 5 is enough
    blank = [x for x in got if x[0] == 5]
    assert len(blank) == 1 and not blank[0][1]
    want = [(1, one), (1, two), (3, three), (6, ""), (None, one), (7, "x y"), (7, "x z")]
    assert [x for x in got if x[0] != 5] == sorted(want, key=str)


def test_repeated_vec_id(spark):
    r = np.random.default_rng(4)
    base = np.linalg.qr(r.standard_normal((12, 12)))[0]
    close = lambda k: base[k] + 0.02 * r.standard_normal(12)
    rows = [(1, base[0]), (1, base[1]), (10, close(0)), (11, close(0)), (12, close(0)), (20, close(1)), (2, base[5]), (2, base[5]), (0, close(5)), (30, base[7]), (3, base[8]), (3, base[9])]
    vectors = [[float(c) for c in v] for _, v in rows]
    df = spark.createDataFrame([(i, v, 1) for (i, _), v in zip(rows, vectors)], "vec_id long, embedding array<double>, copies int")
    unit = np.array([np.array(v) / np.linalg.norm(v) for v in vectors])
    linked = unit @ unit.T >= 0.9
    reach = np.linalg.matrix_power(linked.astype(float), 12) > 0
    want = sorted((i, int(linked[k].sum()) - 1, min(rows[j][0] for j in np.flatnonzero(reach[k]))) for k, (i, _) in enumerate(rows))
    out = embedding_dedup.groups(df).collect()
    assert sorted((x["vec_id"], x["n_links"], x["component_id"]) for x in out) == want
    assert all(x["kept"] == (x["vec_id"] == x["component_id"]) for x in out)
