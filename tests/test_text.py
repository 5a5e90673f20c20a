"""Cleaning, entities and times."""

import re

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from veristream.functions import labels, text as tx, times
from veristream.schemas import OCR_REPLY


EDGES = [
    "A B", "<b>x\ny</b>", "a&nbsp;b &amp;c", "see http://x.id/<b>now</b> ok", "www.a.id<i>", "😀 Hai",
    " edge\x1c", "", "<>", "a\r<b\r>c", "HTTPS://X y", "\x85x\x85", "1<2>3", "ÀÉ",
]


# What each cleaning makes of EDGES, in their order.
EXPECTED = [
    (tx.clean_train, [
        "a b", "x y", "a nbsp b amp c", "see ok", "", "hai", "edge", "", "", "a c", "y", "x", "1 3", "",
    ]),
    (tx.clean_similarity, [
        "a b", "x y", "a b c", "see now ok", "", "hai", "edge", "", "", "a c", "y", "x", "1 3", "",
    ]),
    (tx.clean_serve, [
        "a\xa0b", "b x\ny  b", "a nbsp b  amp c", "see   ok", "", "hai", "edge", "", "", "a\r b\r c", "y", "x", "1 2 3", "",
    ]),
    (tx.strip_tags, [
        "A B", "x y", "a&nbsp;b &amp;c", "see http://x.id/ now ok", "www.a.id", "😀 Hai", "edge", "", "<>", "a c",
        "HTTPS://X y", "x", "1 3", "ÀÉ",
    ]),
]


@pytest.mark.parametrize("clean,expected", EXPECTED)
def test_cleaning_edges(spark, clean, expected):
    df = spark.createDataFrame([(t,) for t in EDGES], "text string")
    assert [r["out"] for r in df.select(clean(F.col("text")).alias("out")).collect()] == expected


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet="ab <>&;/:.htpw\n\t  1é", max_size=40), min_size=20, max_size=60))
def test_cleaning_properties(spark, texts):
    """Only the alphabet stays, no two blanks meet, nothing is left to strip, and cleaning again changes nothing."""
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for clean in (tx.clean_train, tx.clean_similarity):
        once = df.select(clean(F.col("text")).alias("text"))
        rows = once.select("text", clean(F.col("text")).alias("again")).collect()
        for row in rows:
            assert re.fullmatch(r"(?:[a-z0-9]+(?: [a-z0-9]+)*)?", row["text"])
            assert row["again"] == row["text"]
    for row in df.select(tx.clean_serve(F.col("text")).alias("s"), tx.strip_tags(F.col("text")).alias("t")).collect():
        assert row["s"] == row["s"].strip() and row["t"] == row["t"].strip()
        assert not re.search(r"\s\s", row["t"])


def test_container_text_holds_nested_blocks(one):
    page = '<div class="entry-content"><p>satu</p><div>dua</div><p>tiga</p></div><div>x</div>'
    assert one(tx.container_text, page) == "satu dua tiga"
    assert one(tx.container_text, '<div class="post-content">a<DIV>b</DIV ></div>c') == "a b"
    assert one(tx.container_text, '<div class="entry-content">open') == "open"
    assert one(tx.container_text, "none") == ""


@pytest.mark.parametrize("given_time,expected", [
    ("Mon, 29 Jun 2026 10:00:00 +0700", "2026-06-29T03:00:00Z"), ("2026-06-29T03:00:00Z", "2026-06-29T03:00:00Z"),
    ("2026-06-29T10:00:00+07:00", "2026-06-29T03:00:00Z"), ("x", "x"), ("", ""),
])
def test_sortable_times(one, given_time, expected):
    assert one(times.sortable, given_time) == expected


@pytest.mark.parametrize("text", [
    "hub 081299998888 ya", "+6281234567890", "0812-9999-8888", "wa.me/6281234567890",
    "rek 1234567890 BCA", "é081299998888", "x08123456789", "١٢٣٤٥٦٧٨٩٠", "bit.ly/a http://b t.me/c",
    "08" + "1" * 12, "1" * 17,
])
def test_entities(one, text):
    want = {
        "nomor_hp": re.findall(r"\b(?:08|628|\+628)\d{8,11}\b", text) or None,
        "rekening": re.findall(r"\b\d{10,16}\b", text) or None,
        "links": re.findall(r"(https?://[^\s]+|bit\.ly/[^\s]+|wa\.me/[^\s]+|t\.me/[^\s]+)", text) or None,
    }
    assert one(tx.scam_entities, text).asDict() == want


@pytest.mark.parametrize("html,want", [
    ("<p> a <b>b</b></p><script>x</script><!-- c -->d", "a b d"),
    ("a &amp;lt; b", "a &lt; b"), ("<style>p</style>", ""), (None, ""), ("no tags", "no tags"),
    ("<p>one\n two</p>&nbsp;", "one\n two"),
])
def test_html_to_text(one, html, want):
    assert one(tx.html_to_text, html) == want


def test_article_text(one):
    assert one(tx.article_text, "<h1>t</h1><p>a <b>b</b></p><p class='x'>c</p><pre>no</pre>") == "ab c"
    assert one(tx.article_text, "<h1>t</h1><div>d</div>") == "t d"
    assert len(one(tx.article_text, "<p>" + "x" * 6000 + "</p>")) == 5000


def test_ellipsis(one):
    assert one(tx.ellipsis, "x" * 150) == "x" * 150
    assert one(tx.ellipsis, "x" * 151) == "x" * 147 + "..."


@pytest.mark.parametrize("reply,want", [
    ('```json\n{"kategori":"VALID"}\n```', "VALID"), ('Ini: {"kategori":"HOAX"} ok', "HOAX"),
    ("tidak ada", None), ("{oops", None), ("[1]", None),
])
def test_recover_json(one, reply, want):
    got = one(lambda c: tx.recover_json(c, OCR_REPLY), reply)
    assert (got and got["kategori"]) == want


def test_times(one):
    epoch = lambda c: F.unix_timestamp(times.parse_time(c))
    assert one(epoch, "Mon, 29 Jun 2026 10:00:00 +0700") == 1782702000
    assert one(epoch, "2026-06-29T03:00:00Z") == 1782702000
    assert one(epoch, "garbage") is None
    assert one(times.hour_label, "") == "00"
    assert one(times.hour_label, "2026-06-26T22:00:00Z") == "22"
    assert one(times.hour_label, None) is None


@pytest.mark.parametrize("text,code,feedback", [
    (" Hoax ", 1, None), ("hoaks", 1, None), ("VALID", 0, None), ("apa", 0, None), ("Hoax", 1, 1),
    ("Netral", 3, 3), (None, 0, None),
])
def test_labels(one, text, code, feedback):
    assert one(labels.to_code, text) == code
    assert one(labels.feedback_code, text) == feedback


def test_is_url(one):
    assert one(tx.is_url, " https://a.id/x \n") is True
    assert one(tx.is_url, "https://a.id x") is False


def test_container_and_capitalize(one):
    page = '<div class="a post-content b"> <p>x</p>y </div>'
    assert one(tx.container_text, page) == "x y"
    assert one(tx.container_text, "<div>z</div>") == ""
    assert one(tx.capitalize, "pENIPUAN besar") == "Penipuan besar"


def test_character_references(one):
    import html

    texts = [
        "caf&eacute; &#8217;&#x2026; &#X41;", "&amp;lt; &lt;b&gt;", "&nosuch; & &; &# &#; &#x; &", "&#150;&#128;&#159;", "&copy &reg; &nbsp;x",
        "&#0;&#xD800;&#1114112;", "&#x1F600;", "a&b;c", "&NotEqualTilde; &CounterClockwiseContourIntegral;", "R&D; AT&T",
    ]
    for t in texts:
        assert one(tx.decode_entities, t) == html.unescape(t), t


def test_quoted_ends_of_tags(one):
    assert one(tx.html_to_text, 'a<img alt="x > y">b<i title=\'>\'>c</i>') == "a b c"
    assert one(tx.html_to_text, 'a<img alt="x>b</img> c <b>d') == "a b c d"
    assert one(tx.html_to_text, "x<" + "a" * 20000 + ' t="' + "q" * 20000 + '">y') == "x y"
