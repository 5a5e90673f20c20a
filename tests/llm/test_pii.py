"""Personal data: plain spans against the plain expressions, disguised ones against planted places."""

import random
import re
import time

import pytest

from veristream.llm import pii
from veristream.llm.common import sha

DDL = "doc_id long, text string, spans string, n_email int, key string"


def plain(t):
    """The kinds as they are defined."""
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = [int(c) for c in m[0] if c.isdigit()]
        doubled = [sum(divmod(2 * v, 10)) if i % 2 else v for i, v in enumerate(reversed(d))]
        if 13 <= len(d) <= 19 and sum(doubled) % 10 == 0:
            out.append((2, *m.span()))
    return out + [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]


@pytest.mark.parametrize("alphabet", ["a@.-1", "0123. -+()", "ab.@% +12é", "1.2.3", "0123456789 -", "+10 "])
def test_plain_kinds(alphabet):
    r = random.Random(alphabet)
    for _ in range(4000):
        t = "".join(r.choice(alphabet) for _ in range(r.randrange(40)))
        assert pii.detect(t) == plain(t), t


#: Disguised text, kind.
HIDDEN = [
    ("jane [at] example [dot] com", 0), ("jane.doe (at) mail.example.org", 0), ("john dot doe at example dot com", 0),
    ("jane{at}example{dot}co{dot}uk", 0), ("jane_at_example_dot_com", 0), ("jane-at-example-dot-com", 0), ("jane@example dot com", 0),
    ("JANE AT EXAMPLE DOT COM", 0), ("juan arroba ejemplo punto es", 0), ("ｊａｎｅ＠example．com", 0), ("jаne@exаmple.com", 0),
    ("ja\u200bne@exa\u00admple.com", 0), ("jane [at] exаmple dot com", 0),
    ("192[.]168[.]1[.]1", 1), ("one nine two dot one six eight dot one dot one", 1), ("10 dot 0 dot 0 dot 7", 1), ("１２７.0.0.1", 1),
    ("4l11 1111 1111 1111", 2), ("4111 1111 1111 one one one one", 2), ("٤١١١ ١١١١ ١١١١ ١١١١", 2), ("4111\u00a01111\u00a01111\u00a01111", 2),
    ("vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", 2),
    ("plus four nine one seven one five five five one two three four", 3), ("+1 (nine eight eight) five five five-2485", 3),
    ("+33 un deux trois quatre cinq six sept huit neuf", 3), ("+1 (988) 555\u20112485", 3), ("+1 (988) 555-2O85", 3),
]
#: Nothing personal in these.
CLEAN = [
    "look at example.com and see the dot on it", "stared at the dot on the wall", "one two three", "eins, zwei, drei", "point six at seven",
    "meet us at noon dot", "version 1.2.3", "the year 2024 plus one", "at dot com", "@", "[at] [dot]", "9 - 5 = 4", "null acht fünfzehn", "un deux",
    "привет всем", "καλημέρα", "10l of 2O", "x at y at z dot",
]


@pytest.mark.parametrize("hidden,kind", HIDDEN)
@pytest.mark.parametrize("around", [("", ""), ("Write: ", ", please"), ("ае é\u200b (", ") one two\U0001d7d8 x"), ("[at] ", " [dot]")])
def test_hidden(hidden, kind, around):
    text = around[0] + hidden + around[1]
    found = pii.find(text)[1]
    assert (kind, len(around[0]), len(around[0]) + len(hidden)) in found, [text[a:b] for _, a, b in found]


@pytest.mark.parametrize("text", CLEAN)
def test_clean(text):
    assert pii.find(text) == ([], [])


def test_added_spans_inside_plain_ones_go():
    text = "a one at x@mail.example.com dot"
    plain_spans, more = pii.find(text)
    assert plain_spans == [(0, 9, 27)] and not [s for s in more if s[1] >= 9 and s[2] <= 27]


def test_rewriting_maps_back():
    r = random.Random(5)
    for _ in range(300):
        text = "".join(r.choice("abcdef") for _ in range(30))
        cuts = sorted(r.sample(range(31), 6))
        edits = [(a, b, "X" * r.choice([0, 1, b - a, b - a + 2])) for a, b in zip(cuts[::2], cuts[1::2])]
        done = pii.Rewriting(text, edits)
        origin = []  # source span of every new character, written out
        past = 0
        for a, b, say in edits:
            origin += [(i, i + 1) for i in range(past, a)]
            origin += [(a + k, a + k + 1) for k in range(len(say))] if len(say) == b - a else [(a, b)] * len(say)
            past = b
        origin += [(i, i + 1) for i in range(past, 30)]
        assert len(done.text) == len(origin)
        for s in range(len(origin)):
            for e in range(s + 1, len(origin) + 1):
                assert done.back(s, e) == (origin[s][0], origin[e - 1][1])


def test_report_and_redact(spark):
    texts = [None, "", " ", *[h for h, _ in HIDDEN], *CLEAN, "a@b.co 1.2.3.4 4111 1111 1111 1111 +1 (988) 555-2485 a@b.co", "x " * 400_000 + "a@b.co " + "one two " * 100_000]
    data = [(i % 40, t, "s", 1, "k") for i, t in enumerate(texts)] + [(7, "a@b.co", "s", 1, "k")] * 2 + [(None, "a@b.co", None, None, None)]
    df = spark.createDataFrame(data, DDL).repartition(3)
    want = []
    for i, t, *_ in data:
        base = plain(t or "")
        say = lambda f: ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in f)
        want.append((i, *[sum(k == s[0] for s in base) for k in range(4)], sha(say(base)), say(sorted(base + pii.find(t or "")[1]))))
    out = pii.report(df)
    assert out.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    order = lambda rows: sorted(rows, key=str)
    assert order(tuple(r) for r in out.collect()) == order(want)
    assert pii.report(df.limit(0)).count() == 0
    found = pii.spans(df.where("doc_id = 7 and text = 'a@b.co'")).collect()
    assert [[tuple(s) for s in r["spans"]] for r in found] == [[("email", 0, 6, False)]] * 2
    clean = spark.createDataFrame([(1, "to jаne@exаmple.com or +1 (988) 555-2485!"), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["text"] for r in pii.redact(clean).collect()} == {1: "to <email> or <phone>!", 2: ""}


@pytest.mark.parametrize("piece", ["a", "1", "1.1", "+1 ", "at ", "a at a ", "one ", "@", "a@", "1 ", "a dot ", "(at", "l0", "a@a.", "a at a dot ", "- "])
def test_linear(piece):
    took = []
    for n in (30_000, 240_000):
        started = time.perf_counter()
        pii.find(piece * (n // len(piece)))
        took.append(time.perf_counter() - started)
    assert took[1] < 24 * took[0] + 0.2  # 8 times the text
