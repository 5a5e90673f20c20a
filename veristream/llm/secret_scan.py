"""Secrets by a trigram index.

Each rule's expression gives a Boolean query over trigrams that any match must hold.
A bounded run of documents gets an inverted index (trigram -> sorted postings) over the
trigrams that the rules ask for; postings are intersected and united as the query says,
and only the remaining documents are read by the expression itself.  A rule without a
mandatory trigram is run over every text.  The index is split by document, so nothing is
shuffled and no posting list grows beyond a run.

Nulls count as empty texts, which have no spans.  Repeated rows and ids are kept, a row
each; a document of any length is scanned whole.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from veristream.llm.common import per_text, sha


@dataclass(frozen=True)
class Rule:
    """``literals``: a list of alternatives, each a list of strings that a match by that alternative
    holds, in any case; empty: no mandatory trigram.  ``keep``: least length of group ``group``."""

    kind: str
    pattern: str
    literals: tuple[tuple[str, ...], ...] = ()
    group: int = 0
    keep: int = 0


def any_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


KEYS = ("password", "passwd", "secret", "token", "api_?key")

#: The kinds of the contract, in its order.
BASE = (
    Rule(
        "assign",
        "(" + "|".join(map(any_case, KEYS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        (("password",), ("passwd",), ("secret",), ("token",), ("api", "key")), 2, 6,
    ),
    Rule("access", "AKIA[A-Z0-9]+", (("AKIA",),), 0, 20),
    Rule("hex", "[0-9a-f]{24,}"),
)
#: Kinds that the operator adds: other public token shapes.
MORE = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", (("-----BEGIN ", "PRIVATE KEY-----"),)),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}", (("gho_",), ("ghp_",), ("ghs_",), ("ghu_",))),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", (("xoxa-",), ("xoxb-",), ("xoxp-",), ("xoxr-",), ("xoxs-",))),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", (("eyJ", ".eyJ"),)),
)


def trigrams(literal: str) -> list[int]:
    raw = literal.lower().encode()
    return [raw[i] << 16 | raw[i + 1] << 8 | raw[i + 2] for i in range(len(raw) - 2)]


def query(rule: Rule) -> list[list[int]]:
    """Alternatives of trigrams that all have to be there; empty: scan everything.

    An alternative without any trigram would match everywhere, so it makes the rule scan all.
    """
    out = [sorted({g for text in alternative for g in trigrams(text)}) for alternative in rule.literals]
    return out if out and all(out) else []


class Index:
    """Postings of a run of documents for the given trigrams (ASCII case ignored)."""

    #: Bytes looked at together.
    BLOCK = 4_000_000

    def __init__(self, texts: list[str], wanted: np.ndarray, seen: np.ndarray):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        stop = np.cumsum([len(r) + 1 for r in raw])  # a line end between texts, in no trigram asked for
        data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        gram, place = [], []
        for a in range(0, len(data) - 2, self.BLOCK):
            part = data[a : a + self.BLOCK + 2]
            low = np.where((part >= 65) & (part <= 90), part + np.uint8(32), part).astype(np.uint32)
            code = low[:-2] << np.uint32(16) | low[1:-1] << np.uint32(8) | low[2:]
            at = np.flatnonzero(seen[code])
            gram.append(code[at])
            place.append(at + a)
        self.wanted = wanted
        if not gram:
            self.postings = {}
            return
        gram = np.concatenate(gram)
        row = np.searchsorted(stop, np.concatenate(place), side="right")
        both = np.unique(gram.astype(np.int64) << 32 | row)
        cut = np.searchsorted(both, wanted.astype(np.int64) << 32)
        cut = [*cut.tolist(), len(both)]
        self.postings = {
            int(g): both[a:b] & 0xFFFFFFFF for g, a, b in zip(wanted, cut[:-1], cut[1:])
        }

    def find(self, alternatives: list[list[int]]) -> list[int]:
        """Documents that hold all trigrams of some alternative."""
        out = np.empty(0, np.int64)
        for grams in alternatives:
            lists = sorted((self.postings.get(g, out[:0]) for g in grams), key=len)
            rows = lists[0]
            for other in lists[1:]:
                if not len(rows):
                    break
                rows = np.intersect1d(rows, other, assume_unique=True)
            out = np.union1d(out, rows)
        return out.astype(np.int64).tolist()


def scanner(rules: tuple[Rule, ...]):
    """A function from texts to a list of (start, rule number, end) for each, sorted."""
    compiled = [re.compile(r.pattern) for r in rules]
    queries = [query(r) for r in rules]
    wanted = np.array(sorted({g for q in queries for a in q for g in a}), np.uint32)
    seen = np.zeros(1 << 24, bool)
    seen[wanted] = True

    def scan(texts: list[str]) -> list[list[tuple[int, int, int]]]:
        index = Index(texts, wanted, seen)
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for k, rule in enumerate(rules):
            rows = index.find(queries[k]) if queries[k] else range(len(texts))
            for i in rows:
                for m in compiled[k].finditer(texts[i]):
                    if m.end(rule.group) - m.start(rule.group) >= rule.keep:
                        found[i].append((m.start(), k, m.end()))
        for f in found:
            f.sort()
        return found

    return scan


def spans(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and its spans as ``array<struct<kind, start, end>>`` (code points, end exclusive), by start."""

    def work():
        scan = scanner(rules)
        return lambda keys, texts: {
            key: keys,
            "spans": [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in f] for f in scan(texts)],
        }

    kind = docs.schema[key].dataType.simpleString()
    return per_text(docs, key, text, f"`{key}` {kind}, spans array<struct<kind string, start long, end long>>", work)


def report(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts of the base kinds, digest of their spans, and all spans as a string."""

    def work():
        scan = scanner(BASE + MORE)
        names = [r.kind for r in BASE + MORE]
        say = lambda f: ",".join([f"{names[k]}:{a}:{b}" for a, k, b in f])

        def step(keys, texts):
            found = scan(texts)
            base = [[s for s in f if s[1] < len(BASE)] for f in found]
            count = lambda k: [sum(s[1] == k for s in f) for f in base]
            return {
                key: keys, "n_assign": count(0), "n_access": count(1), "n_hex": count(2),
                "base_sha256": [sha(say(f)) for f in base], "spans": [say(f) for f in found],
            }

        return step

    kind = docs.schema[key].dataType.simpleString()
    return per_text(
        docs, key, text,
        f"`{key}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string", work,
    )
