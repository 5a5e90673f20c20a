"""Source divergence against plain sums in Python's whole numbers."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from veristream.llm import source_audit as sa

DDL = "doc_id long, text string, lang string, source string, n long, term string, value long"
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(data):
    """Rows as the query is to return them."""
    count, within, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, *_ in data:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOW))
        count[lang, source].update(terms)
        within[lang].update(set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for t, n in within[lang].items() if n >= 3]
        mine = sorted(s for la, s in groups if la == lang)
        total = Counter()
        for s in mine:
            total.update({t: count[lang, s][t] for t in kept})
        p = {}
        for name, c in [(s, count[lang, s]) for s in mine] + [(None, total)]:
            n = sum(c[t] for t in kept)
            p[name] = {t: 1 + 10**9 * (c[t] + 1) // (n + len(kept)) for t in kept}
        f = lambda x, y: (x - y) ** 2 // y
        for s in mine:
            pair = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in mine if o != s]
            term = [(f(p[s][t], p[None][t]), t) for t in kept if count[lang, s][t] > 0 and p[s][t] > p[None][t]]
            for part, rows, most in (("pair", pair, None), ("term", term, 200)):
                rows.sort(key=lambda r: (-r[0], r[1].encode()))
                out += [(lang, s, part, item, v, k + 1) for k, (v, item) in enumerate(rows[:most])]
    return sorted(out)


def rows(n=160, seed=4):
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcéßZ") for _ in range(r.randrange(1, 5))) for _ in range(300)]
    out = []
    for i in range(n):
        lang, source = r.choice(["en", "de", None, ""]), r.choice(["s0"] * 4 + [f"s{k}" for k in range(9)] + [None, "é", "Z"])
        words = [vocab[min(int(r.expovariate(0.02)), 299)] for _ in range(r.randrange(60))]
        out.append((i % 120, r.choice([" ", "-1", "\n", "_"]).join(words), lang, source))
    out += [(1, None, "en", "bare"), (2, "", "en", "s0"), (3, "123 _", "xx", "only"), (4, "one two", "yy", "a"), (5, "three", "yy", "b"), (6, None, "yy", None)]
    out += [(7, "same same words", "en", "s1")] * 3 + [(8, " ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676)}" for k in range(2000)), "de", f"s{k}") for k in range(3)]
    return [(*x, 1, "x", 2) for x in out]


def got(df):
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("strip,block", [(sa.STRIP, sa.BLOCK), (3, 40), (1, 700), (48, 1)])
def test_audit(spark, strip, block):
    data = rows() if block > 1 else rows(40)[:50]
    df = spark.createDataFrame(data, DDL).repartition(4)
    assert got(sa.audit(df, strip, block)) == brute(data)


def test_empty(spark):
    assert got(sa.audit(spark.createDataFrame([], DDL))) == []


def test_ties_beyond_the_last_rank(spark):
    data = [(i, " ".join(f"t{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(400)), "en", "a", 1, "x", 1) for i in range(3)] + [(9, "other", "en", "b", 1, "x", 1)] * 3
    assert got(sa.audit(spark.createDataFrame(data, DDL))) == brute(data)


def test_share_is_exact():
    r = random.Random(2)
    for _ in range(3000):
        total = r.randrange(1, 10 ** r.randrange(1, 16))
        n = r.randrange(total)
        assert int(sa.share(np.array([n]), np.array([total]))[0]) == 1 + 10**9 * (n + 1) // total


@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 5, 17), (20, 20, 300), (7, 30, 64), (70, 2, 9), (5, 5, 0)])
def test_walk_covers_every_pair(shape):
    r = np.random.default_rng(sum(shape))
    one, two = (r.random((n, shape[2])) < 0.1 for n in shape[:2])
    for left, right, same in ((one, two, False), (one, one, True)):
        seen = np.zeros((len(left), len(right), shape[2]), int)
        depth = max(sa._depth(n) for m in (left, right) for n in m.shape)
        trees = [sa.Tree(m, depth) for m in (left, right)]
        leaf = lambda a, b, c: np.add.at(seen, (a, b, c), 1)
        zero = sa.walk(trees[0], trees[1], (len(left), len(right)), shape[2], same, leaf)
        either = left[:, None, :] | right[None, :, :]
        pairs = np.triu(np.ones((len(left), len(right)), bool), 1) if same else np.ones((len(left), len(right)), bool)
        assert (seen == either * pairs[:, :, None]).all()
        assert (zero == (~either).sum(2))[pairs].all()


def test_pieces_cut_no_term(monkeypatch):
    monkeypatch.setattr(sa, "PIECE", 7)
    data = "ab cd-éfghijklmno p  qqqqqqqqqqqqqqqqqqqq r".encode()
    assert [t for p in sa._pieces(data) for t in sa._term.findall(p)] == sa._term.findall(data)
    assert b"".join(sa._pieces(data)) == data
