"""Personal data, disguised or not, with its place in the source text.

Plain identifiers are found in the source text as it stands.  Then three transducers rewrite
the text one after the other: lookalike characters (other scripts, wide and styled forms,
invisible ones), digits (spelled in four languages, or letters standing for them), and
disguised marks (``[at]``, `` dot ``, ``plus``).  A rewriting remembers only its edits; a
position is mapped back through them by bisection, so a span found in the rewritten text
becomes a span of source characters.  Found spans that hold no edit, or lie within a plain
span of their kind, add nothing and go.

Every search is linear in the text.  Nulls count as empty texts, which have no spans; a text
of any length is scanned whole.  Rows with the same id, equal or not, are rows of their own;
no other column is read.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterable
from functools import cache

from pyspark.sql import DataFrame

from veristream.llm.common import per_text, sha

KINDS = ("email", "ip", "card", "phone")

# Characters that look like ASCII ones, words for digits and marks.
LOOKALIKES = {
    "a": "аαɑ", "b": "ЬƄ", "c": "сϲ", "d": "ԁ", "e": "еҽ", "g": "ɡ", "h": "һ", "i": "іιı", "j": "јϳ", "k": "κ", "l": "ӏ", "m": "ⅿ",
    "n": "ո", "o": "оοօ", "p": "рρ", "q": "ԛ", "s": "ѕ", "u": "υս", "v": "νѵ", "w": "ԝ", "x": "хⅹ", "y": "уγ",
    "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ",
    "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "УΥ", "Z": "Ζ",
    "-": "\u2010\u2011\u2012\u2013\u2014\u2015\u2212", ".": "\u2024\u3002", "@": "\ufe6b",
    " ": "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000",
}
INVISIBLE = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
DIGIT_WORDS = {
    "0": ("zero", "oh", "null", "zéro", "cero"), "1": ("one", "eins", "un", "uno"), "2": ("two", "zwei", "zwo", "deux", "dos"),
    "3": ("three", "drei", "trois", "tres"), "4": ("four", "vier", "quatre", "cuatro"), "5": ("five", "fünf", "cinq", "cinco"),
    "6": ("six", "sechs", "seis"), "7": ("seven", "sieben", "sept", "siete"), "8": ("eight", "acht", "huit", "ocho"),
    "9": ("nine", "neun", "neuf", "nueve"),
}
AT_WORDS = ("at", "arroba", "arobase", "ät")
DOT_WORDS = ("dot", "punkt", "point", "punto")
PLUS_WORDS = ("plus", "más")
#: Domain ends that a domain of plain words must have; brackets need none.
ENDS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "ai", "app", "dev", "eu", "uk", "us", "ca", "au", "de", "at", "ch", "fr", "be", "es", "mx", "ar", "it", "nl", "pt", "br", "pl", "se", "no", "dk", "fi", "ru", "in", "id", "jp", "cn", "kr")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile("[0-9]")


def luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(2 * int(d) - 9 * (d > "4") for d in even)) % 10 == 0


def emails(text: str) -> Iterable[tuple[int, int]]:
    """Leftmost matches, found from their ``@``: a run before it, a domain behind it."""
    past, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > past and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        past = m.end() if m else at + 1
        at = text.find("@", past)


def detect(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the plain identifiers, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(1, m.start(), m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 13 and 13 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and luhn(d):
                out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return out


class Rewriting:
    """A text with some runs replaced, and the way back.

    ``edits``: (start, end, replacement), in order, not overlapping.  A replacement as long as
    what it replaces stands for it character by character, another one stands for the whole.
    """

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        parts, past, size = [], 0, 0
        self.edits, self.new = edits, []
        for a, b, say in edits:
            parts += (text[past:a], say)
            size += a - past
            self.new.append(size)
            size += len(say)
            past = b
        self.text = "".join([*parts, text[past:]])

    def _source(self, at: int) -> tuple[int, int]:
        k = bisect_right(self.new, at) - 1
        if k < 0:
            return at, at + 1
        (a, b, say), off = self.edits[k], at - self.new[k]
        if off >= len(say):
            a = b + off - len(say)
        elif len(say) != b - a:
            return a, b
        else:
            a += off
        return a, a + 1

    def back(self, start: int, end: int) -> tuple[int, int]:
        """Source characters of the non-empty span."""
        return self._source(start)[0], self._source(end - 1)[1]


@cache
def _characters() -> tuple[re.Pattern, dict[int, str]]:
    """The characters to replace, as a pattern of runs and as a table."""
    table = {ord(c): plain for plain, some in LOOKALIKES.items() for c in some}
    styled = [*range(0x2460, 0x2500), *range(0xFF01, 0xFF5F), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1F150)]
    digits = [c for c in range(0x80, 0x1FC00) if unicodedata.category(chr(c)) == "Nd"]
    for c in styled + digits:
        plain = str(unicodedata.decimal(chr(c), "")) or unicodedata.normalize("NFKC", chr(c))
        if len(plain) == 1 and plain.isascii():
            table.setdefault(c, plain)
    # Classes beyond the basic plane are slow to test, so they stand apart.
    some = ["".join(re.escape(chr(c)) for c in sorted(table) if (c > 0xFFFF) == far) for far in (False, True)]
    return re.compile(f"(?:[{some[0]}]|[{some[1]}])+|[{INVISIBLE}]+"), table


#: Whatever may be in the table, in few ranges.
UNUSUAL = re.compile("[\xa0\xad\u0131\u0180-\U0010ffff]")


def lookalikes(text: str) -> list[tuple[int, int, str]]:
    if text.isascii() or not UNUSUAL.search(text):
        return []
    pattern, table = _characters()
    return [(m.start(), m.end(), "" if m[0][0] in INVISIBLE else m[0].translate(table)) for m in pattern.finditer(text)]


def _any(words: Iterable[str]) -> str:
    """A pattern of the words, longer ones first, those with the same first character together."""
    heads: dict[str, list[str]] = {}
    for w in sorted(words, key=len, reverse=True):
        heads.setdefault(w[0], []).append(w[1:])
    return "(?:" + "|".join(h + (f"(?:{'|'.join(t)})" if len(t) > 1 else t[0]) for h, t in heads.items()) + ")"


VALUES = {w: d for d, words in DIGIT_WORDS.items() for w in words} | {str(d): str(d) for d in range(10)}
DOT = rf"(?:\s{{0,2}}[\[({{<]\s{{0,2}}(?:{_any(DOT_WORDS)}|\.)\s{{0,2}}[\])}}>]\s{{0,2}}|(?:\s|[_-]){_any(DOT_WORDS)}(?:\s|[_-]))"
SPOKEN = re.compile(rf"\b{_any(VALUES)}\b(?:[\x20-]{{1,2}}{_any(VALUES)}\b)*+")
TELLING = re.compile("[^0-9\\x20-]")
DOT_NEXT, DOT_LAST = re.compile(DOT), re.compile(rf"{DOT}\Z")
# Quick looks at a lower-case text, so that the searches above and below run on few texts.
_WORD = _any(w for w in VALUES if not w.isdigit())
TWO_SPOKEN = re.compile(rf"{_WORD}[\x20-]{{1,2}}(?:{_WORD}|[0-9])|[0-9][\x20-]{{1,2}}{_WORD}")
DOT_SEEN = re.compile(rf"{_any(DOT_WORDS)}|[\[({{<]\s{{0,2}}\.|[\[({{<]\s{{0,2}}{_any([*AT_WORDS, '@'])}\s{{0,2}}[\])}}>]")
PLUS_SEEN = re.compile(rf"{_any(PLUS_WORDS)}\s{{0,2}}[0-9(]")
MIXED_SEEN = re.compile("[0-9][OolI]|[OolI][0-9]")
#: A number with letters in it that look like digits, and no other letters beside it.
MIXED = re.compile(r"(?<![^\W_])(?=[OolI]*+[0-9])(?=[0-9]*+[OolI])[0-9OolI]++(?![^\W_])")
AS_DIGITS = str.maketrans("OolI", "0011")


def lower(text: str) -> str:
    """Lower case, character by character."""
    low = text.lower()
    return low if len(low) == len(text) else "".join([c if len(c.lower()) > 1 else c.lower() for c in text])


def digits(text: str) -> list[tuple[int, int, str]]:
    """Spelled digits, runs joined; one alone only beside a spelled dot.  Letters inside numbers."""
    out, low = [], lower(text)
    if TWO_SPOKEN.search(low) or DOT_SEEN.search(low):
        for m in SPOKEN.finditer(low):
            if not TELLING.search(m[0]):
                continue
            said = re.split(r"[\x20-]+", m[0])
            if len(said) == 1 and not (DOT_NEXT.match(low, m.end()) or DOT_LAST.search(low, max(0, m.start() - 16), m.start())):
                continue
            if set(said) == {"oh"}:
                continue
            out.append((m.start(), m.end(), "".join([VALUES[w] for w in said])))
    if MIXED_SEEN.search(text):
        out += [(m.start(), m.end(), m[0].translate(AS_DIGITS)) for m in MIXED.finditer(text)]
        out.sort()
    return out


NAME = r"[a-z0-9]++(?:-(?!" + _any(DOT_WORDS) + r"-)[a-z0-9]++)*+"
AT = re.compile(rf"[\[({{<]\s{{0,2}}(?:{_any(AT_WORDS)}|@)\s{{0,2}}[\])}}>]|[\s_-]{_any(AT_WORDS)}[\s_-]|@")
HOST = re.compile(rf"{NAME}(?:(?:{DOT}|\.){NAME})+")
DOTS = re.compile(rf"(?=[\s\[({{<_-]){DOT}")
FIRST = re.compile(rf"(?<![a-z0-9._%+-])[a-z0-9_%+-]+({DOT})\Z")
NUMBERS = re.compile(rf"[0-9]{{1,3}}(?:(?:{DOT}|\.)[0-9]{{1,3}}){{3}}(?![0-9])")
PLUS = re.compile(rf"{_any(PLUS_WORDS)}\s{{0,2}}(?=[0-9(])")
BLANKS = re.compile(r"\s{0,2}")
#: Characters before an ``at`` in which dots of the local part are looked for (the mail standard allows 64).
REACH = 96


def marks(text: str) -> list[tuple[int, int, str]]:
    """Disguised ``@``, ``.`` and ``+``, each only inside something shaped like an identifier."""
    out, past, low = [], 0, lower(text)
    if DOT_SEEN.search(low):
        for m in AT.finditer(low):
            a, b = m.span()
            worded = m[0][0] not in "[({<@"
            if not worded:  # blanks around belong to the disguise
                b = BLANKS.match(low, b).end()
                while a > max(0, m.start() - 2) and low[a - 1].isspace():
                    a -= 1
            if a < past or not a or low[a - 1] not in LOCAL or not (host := HOST.match(low, b)):
                continue
            dots = [(d.start(), d.end(), ".") for d in DOTS.finditer(low, host.start(), host.end())]
            if worded and not (dots and re.split("[^a-z0-9]+", host[0])[-1] in ENDS) or m[0] == "@" and not dots:
                continue
            left, end = [], a
            while dot := FIRST.search(low, max(past, end - REACH), end - _tail(low, end)):
                left.append((dot.start(1), dot.end(1), "."))
                end = dot.start(1)
            out += [*left[::-1], (a, b, "@"), *dots]
            past = host.end()
        for m in NUMBERS.finditer(low):
            if not m.start() or low[m.start() - 1] not in "0123456789.":
                out += [(d.start(), d.end(), ".") for d in DOTS.finditer(low, m.start(), m.end())]
    if PLUS_SEEN.search(low):
        out += [(m.start(), m.end(), "+") for m in PLUS.finditer(low) if not (m.start() and low[m.start() - 1].isalnum())]
    out.sort()
    keep, past = [], 0
    for edit in out:
        if edit[0] >= past:
            keep.append(edit)
            past = edit[1]
    return keep


def _tail(text: str, end: int) -> int:
    """Length of the run of local characters that ends at ``end``, at most REACH."""
    n = 0
    while n < min(end, REACH) and text[end - n - 1] in LOCAL:
        n += 1
    return n


def find(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Plain spans, and those that the rewriting adds, as (kind number, start, end) of the source."""
    plain = detect(text)
    chain, now = [], text
    for transducer in (lookalikes, digits, marks):
        edits = transducer(now)
        if edits:
            chain.append(Rewriting(now, edits))
            now = chain[-1].text
    if not chain:
        return plain, []
    more = set()
    for kind, start, end in detect(now):
        a, b = start, end
        for step in reversed(chain):
            a, b = step.back(a, b)
        if text[a:b] != now[start:end]:
            more.add((kind, a, b))
    by_kind = {k: [s for s in plain if s[0] == k] for k in range(len(KINDS))}
    starts = {k: [s[1] for s in some] for k, some in by_kind.items()}

    def inside(span):
        k = bisect_right(starts[span[0]], span[1]) - 1
        return k >= 0 and by_kind[span[0]][k][2] >= span[2]

    return plain, sorted(s for s in more if not inside(s))


def spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and its spans as ``array<struct<kind, start, end, disguised>>``, by kind and start."""

    def step(keys, texts):
        out = []
        for t in texts:
            plain, more = find(t)
            out.append([{"kind": KINDS[k], "start": a, "end": b, "disguised": d} for k, a, b, d in sorted([*[(*s, False) for s in plain], *[(*s, True) for s in more]])])
        return {key: keys, "spans": out}

    kind = docs.schema[key].dataType.simpleString()
    return per_text(docs, key, text, f"`{key}` {kind}, spans array<struct<kind string, start long, end long, disguised boolean>>", lambda: step)


def mask(text: str) -> str:
    """The text with every found span replaced by its kind in angle brackets; overlapping spans as one."""
    plain, more = find(text)
    out, past = [], 0
    runs: list[list] = []
    for a, b, k in sorted((a, b, k) for k, a, b in plain + more):
        if runs and a < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], b)
        else:
            runs.append([a, b, k])
    for a, b, k in runs:
        out += (text[past:a], f"<{KINDS[k]}>")
        past = b
    return "".join([*out, text[past:]])


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and the masked text."""
    kind = docs.schema[key].dataType.simpleString()
    return per_text(docs, key, text, f"`{key}` {kind}, `{text}` string", lambda: lambda keys, texts: {key: keys, text: list(map(mask, texts))})


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of plain identifiers, digest of their spans, and all spans as a string."""
    say = lambda found: ",".join([f"{KINDS[k]}:{a}:{b}" for k, a, b in found])

    def step(keys, texts):
        both = [find(t) for t in texts]
        out = {f"n_{name}": [sum(s[0] == k for s in plain) for plain, _ in both] for k, name in enumerate(KINDS)}
        return out | {
            key: keys, "base_sha256": [sha(say(plain)) for plain, _ in both],
            "spans": [say(sorted(plain + more)) for plain, more in both],
        }

    kind = docs.schema[key].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return per_text(docs, key, text, f"`{key}` {kind}, {counts}, base_sha256 string, spans string", lambda: step)
