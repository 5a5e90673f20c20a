"""Toxicity by a learnt lexicon, misspellings included.

From a bounded sample of labelled documents come terms (words, and stems that many words
start with) far more frequent in toxic documents.  They form a trie.  Words are read by the
product of that trie with a Levenshtein automaton, made deterministic step by step as words
need it, so a misspelt term is found in one pass over its letters.  Every hit gets a score
from its window of neighbours: quotation marks around it or words that report speech before
it speak for quotation, which weighs less than abuse.  A logistic model over the weighted
hits gives the score.

Nulls count as empty texts; they get the score of a text without hits.  Repeated rows and ids
are kept, a row each.  Label rows without id, without label or without document are not used;
a document labelled twice differently counts as toxic.  Without usable labels the lexicon is
empty and all documents get the same score, below 0.5.  Source, language and labels are never
inputs of a score, and no other column is read.  Texts of any length are scored whole.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
from pyspark.sql import DataFrame, functions as F

from veristream.llm.common import per_text
from veristream.llm.quality_rules import held_out

#: Neighbours looked at on either side of a hit.
WINDOW = 6
#: How much of a hit's weight quotation takes away at most.
DISCOUNT = 0.7
REPORTING = frozenset(
    "said says say called calls call wrote writes word term quote quoted cited slur insult "
    "sagte schrieb wort dit écrit mot dijo escribió palabra katanya menulis kata".split()
)
ADDRESS = frozenset("you your you're ur du dein tu toi vous tú usted kamu lu anda".split())
OPENING, CLOSING = "\"'“„«‘`", "\"'”“»’`"
DIGIT_LETTERS = str.maketrans("013457@$", "oieastas")
PART = re.compile(r"[^\W_]+")
PREFIXES = range(4, 11)


def edits(term: str) -> int:
    """Misspellings forgiven in a word or stem: none in short ones, which differ by one letter too easily."""
    return 0 if len(term) < 5 else 1 if len(term) < 8 else 2


class Matcher:
    """The lexicon's trie times a Levenshtein automaton, determinised as it is used.

    A state is a set of (trie node, edits so far).
    ``terms``: (text, is_stem, weight); a stem matches every word that starts with it.
    ``skip``: words that are no hits although they are near a term.
    ``wide``: edits in stems are forgiven too, and the first letter may be wrong.
    """

    MOST_STATES = 50_000
    #: Trie nodes in all states together, which bounds the memory.
    MOST_NODES = 2_000_000

    def __init__(self, terms: list[tuple[str, bool, float]], skip: frozenset[str] = frozenset(), wide: bool = False):
        self.terms, self.skip, self.wide = terms, skip, wide
        self.child: list[dict[str, int]] = [{}]
        self.most = [0]  # edits that some term below a node forgives
        self.word: dict[int, int] = {}
        self.stem: dict[int, int] = {}
        for i, (text, is_stem, _) in enumerate(terms):
            node, k = 0, 0 if is_stem and not wide else edits(text)
            self.most[0] = max(self.most[0], k)
            for c in text:
                if c not in self.child[node]:
                    self.child[node][c] = len(self.child)
                    self.child.append({})
                    self.most.append(0)
                node = self.child[node][c]
                self.most[node] = max(self.most[node], k)
            (self.stem if is_stem else self.word)[node] = i
        self.letters = {c for d in self.child for c in d}
        self._reset()

    def _reset(self) -> None:
        self.sets: list[tuple] = []
        self.number: dict[tuple, int] = {}
        self.nodes = 0
        self.step: dict[tuple[int, str], int] = {}
        self.result: list[tuple[int, int] | None] = []
        self.sticky: list[tuple[int, int] | None] = []
        self._add({0: 0})

    def _add(self, nodes: dict[int, int]) -> int:
        """Number of the state with these (node: fewest edits), skipped letters included; -1: dead."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            e = nodes[node] + 1
            if node or self.wide:
                for to in self.child[node].values():
                    if e <= self.most[to] and e < nodes.get(to, 9):
                        nodes[to] = e
                        todo.append(to)
        if not nodes:
            return -1
        key = tuple(sorted(nodes.items()))
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.nodes += len(key)
            hits = [(e, self.word[n]) for n, e in key if n in self.word and e <= edits(self.terms[self.word[n]][0])]
            self.result.append(min(hits) if hits else None)
            stems = [(e, self.stem[n]) for n, e in key if n in self.stem and e <= (edits(self.terms[self.stem[n]][0]) if self.wide else 0)]
            self.sticky.append(min(stems) if stems else None)
        return self.number[key]

    def _go(self, state: int, letter: str) -> int:
        out: dict[int, int] = {}
        for node, e in self.sets[state]:
            for c, to in self.child[node].items():
                d = e if c == letter else e + 1 if node or self.wide else 9
                if d <= self.most[to] or d == 0:
                    out[to] = min(d, out.get(to, 9))
            if (node or self.wide) and e + 1 <= self.most[node]:  # one letter too many
                out[node] = min(e + 1, out.get(node, 9))
        return self._add(out)

    def find(self, word: str) -> tuple[int, int] | None:
        """(edits, term number) of the nearest term."""
        if len(self.sets) > self.MOST_STATES or self.nodes > self.MOST_NODES:
            self._reset()
        state, stem = 0, None
        near = word not in self.skip
        for c in word:
            key = state, c if c in self.letters else ""
            state = self.step.get(key, -2)
            if state == -2:
                state = self.step[key] = self._go(*key)
            if state < 0:
                return stem
            new = self.sticky[state]
            if new and (near or not new[0]) and (stem is None or new[0] <= stem[0]):
                stem = new
        hit = self.result[state]
        if hit and hit[0] and not near:
            hit = None
        return min(x for x in (hit, stem) if x) if hit or stem else None


class Reader(dict):
    """Hit of a token as it stands in the text, remembered."""

    LIMIT = 300_000

    def __init__(self, matcher: Matcher):
        super().__init__()
        self.matcher = matcher

    def __missing__(self, token: str):
        if len(self) >= self.LIMIT:
            self.clear()
        best = None
        parts = PART.findall(token)
        if any(c in "013457@$" for c in token):
            parts += PART.findall(token.translate(DIGIT_LETTERS))
        for part in parts:
            hit = self.matcher.find(part)
            if hit and (best is None or hit[0] < best[0]):
                best = (*hit, part)
        self[token] = best
        return best


def quotation(tokens: list[str], at: int) -> float:
    """0: nothing speaks for quotation; 1: all does.

    Marks that open before and close after the hit, and words of reporting before it; words that
    address somebody take away.
    """
    before, after = tokens[max(0, at - WINDOW) : at + 1], tokens[at : at + WINDOW + 1]
    marks = any(t[0] in OPENING for t in before) and any(t.rstrip(".,;:!?")[-1:] in CLOSING for t in after if t.rstrip(".,;:!?"))
    plain = [t.strip(".,;:!?\"'“”„«»()") for t in before[:-1]]
    report = any(t in REPORTING for t in plain)
    address = any(t in ADDRESS for t in plain)
    return min(1.0, max(0.0, 0.6 * marks + 0.5 * report - 0.3 * address))


def hits(reader: Reader, text: str) -> tuple[int, list[tuple[int, int, str, float]]]:
    """Number of tokens, and (edits, term number, word, quotation) of every hit."""
    tokens = text.lower().split()
    get = reader.__getitem__
    return len(tokens), [(*m, quotation(tokens, i)) for i, m in enumerate(map(get, tokens)) if m]


def features(n: int, found: list, terms: list) -> list[float]:
    mass = sum(terms[t][2] * (1 - DISCOUNT * q) / (1 + e) for e, t, _, q in found)
    return [1.0, float(np.log1p(mass)), float(np.sqrt(mass / max(n, 20)))]


# --- learning ----------------------------------------------------------------


def _sample(docs: DataFrame, labels: DataFrame, sample: int) -> DataFrame:
    """(id, y, text) of at most ``sample`` labelled documents outside the held-out fifth, half of each class."""
    known = labels.select(F.col("doc_id").alias("id"), F.col("toxic").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))
    )
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample // 2) for y in (0, 1)]
    chosen = parts[0].unionByName(parts[1]).groupBy("id").agg(F.max("y").alias("y"))
    return docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id")


def choose_terms(rows: list, n_toxic: int, n_clean: int, least: int = 4, lift: float = 20.0) -> list[tuple[str, bool, float]]:
    """Terms from (term, is_stem, neighbourhoods in toxic documents, in clean documents).

    A word needs ``least`` of the former and to be ``lift`` times as frequent there.  A stem needs
    the same and at least four different words, none of which makes up most of it; of stems
    that say the same, the longest.  Words that a stem covers stay, after the stems: an unedited
    word is the stem's, a misspelt one is theirs, since longer texts forgive more edits.
    """
    odds = lambda t, c: ((t + 0.5) / (n_toxic + 1)) / ((c + 0.5) / (n_clean + 1))
    good = {(r["term"], r["stem"]): r for r in rows if r["t"] >= least and odds(r["t"], r["c"]) >= lift}
    words = [w for w, stem in good if not stem]
    below: dict[str, list[int]] = defaultdict(list)
    for r in rows:
        if not r["stem"]:
            for k in PREFIXES:
                if len(r["term"]) > k:
                    below[r["term"][:k]].append(r["t"])
    stems: dict[str, int] = {}
    for (s, stem), r in sorted(good.items()):
        if stem and len(below[s]) >= 4 and max(below[s]) <= 0.5 * sum(below[s]):
            for k in PREFIXES:  # a shorter one that says no more goes
                if stems.get(s[:k], 1 << 60) <= r["t"] * 1.05 and len(s) > k:
                    del stems[s[:k]]
            if not any(s[:k] in stems for k in PREFIXES if k < len(s)):
                stems[s] = r["t"]
    covered = lambda w: any(w[:k] in stems for k in PREFIXES)
    weight = lambda r: float(min(1.0, np.log(odds(r["t"], r["c"])) / 6))
    out = [(w, False, weight(good[w, False])) for w in sorted(words) if not covered(w)]
    out += [(s, True, weight(good[s, True])) for s in sorted(stems)]
    return out + [(w, False, weight(good[w, False])) for w in sorted(words) if covered(w)]


def fit(docs: DataFrame, labels: DataFrame, sample: int = 10_000, most_terms: int = 20_000) -> dict:
    """Lexicon and model from a bounded sample (``sample`` documents, ``most_terms`` candidates).

    Counting and matching run in the tasks.  To the driver come the most telling candidate terms and,
    per sampled document, its hits.
    """
    some = _sample(docs, labels, sample)
    sizes = {r["y"]: r["n"] for r in some.groupBy("y").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return {"terms": [], "skip": [], "weights": [-3.0, 0.0, 0.0]}
    # Support is the number of different neighbourhoods, so that copies of a text count once.
    found = F.expr(r"regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+', 0)")
    around = F.expr("transform(ws, (w, i) -> struct(w, xxhash64(get(ws, i - 1), get(ws, i + 1)) AS near))")
    word = (
        some.select("y", found.alias("ws")).select("y", F.inline(around))
        .where(F.length("w").between(4, 40)).distinct()
        .groupBy("w").agg(F.sum("y").alias("t"), F.sum(1 - F.col("y")).alias("c"))
    )
    stem = word.select(F.explode(F.expr(
        f"transform(sequence({PREFIXES.start}, least({PREFIXES.stop - 1}, length(w))), k -> left(w, k))"
    )).alias("term"), "t", "c")
    counts = (
        word.select(F.col("w").alias("term"), F.lit(False).alias("stem"), "t", "c")
        .unionByName(stem.groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c")).withColumn("stem", F.lit(True)))
        .where((F.col("t") >= 2) & (F.col("t") * n_clean >= 10 * (F.col("c") + F.lit(0.5)) * n_toxic))
    )
    rows = counts.orderBy(F.desc("t"), "term", "stem").limit(most_terms).collect()
    terms = choose_terms(rows, n_toxic, n_clean, max(4, n_toxic // 150))

    def work():
        reader = Reader(Matcher(terms, wide=True))

        def step(keys, texts):
            found = [hits(reader, t) for t in texts]
            return {
                "id": keys, "n": [n for n, _ in found],
                "hits": [[{"e": e, "t": t, "w": w, "q": q} for e, t, w, q in f] for _, f in found],
            }

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    seen = per_text(some, "id", "text", f"id {kind}, n long, hits array<struct<e int, t int, w string, q double>>", work)
    seen = seen.join(F.broadcast(some.select("id", "y").distinct()), "id").collect()
    seen.sort(key=lambda r: (r["id"], r["n"]))
    clean, toxic = defaultdict(int), defaultdict(int)
    for r in seen:
        for w in {h["w"] for h in r["hits"] if h["e"]}:
            (toxic if r["y"] else clean)[w] += 1
    skip = sorted(w for w in clean if 3 * clean[w] >= toxic[w])
    gone = set(skip)
    x = np.array([
        features(r["n"], [(h["e"], h["t"], h["w"], h["q"]) for h in r["hits"] if not (h["e"] and h["w"] in gone)], terms)
        for r in seen
    ])
    y = np.array([r["y"] for r in seen], float)
    w, class_weight = np.zeros(x.shape[1]), np.where(y == 1, len(y) / 2 / y.sum(), len(y) / 2 / (len(y) - y.sum()))
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = (x * (class_weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        move = np.linalg.solve(hessian, x.T @ (class_weight * (y - p)) - 0.1 * w)
        w = w + move
        if np.abs(move).max() < 1e-8:
            break
    return {"terms": terms, "skip": skip, "weights": w.tolist()}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, held_out, score, predicted and number of hits (found; of them misspelt; quoted)."""
    terms, weights = model["terms"], model["weights"]
    shared = docs.sparkSession.sparkContext.broadcast((terms, frozenset(model["skip"])))

    def work():
        reader = Reader(Matcher(*shared.value, wide=True))

        def step(keys, texts):
            found = [hits(reader, t) for t in texts]
            z = np.array([features(n, f, terms) for n, f in found]) @ np.asarray(weights)
            value = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            return {
                "doc_id": keys, "score": value, "predicted": (value >= 0.5).astype(np.int32),
                "n_hits": [len(f) for _, f in found], "n_misspelt": [sum(h[0] > 0 for h in f) for _, f in found],
                "n_quoted": [sum(h[3] >= 0.5 for h in f) for _, f in found],
            }

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    out = per_text(
        docs, "doc_id", "text",
        f"doc_id {kind}, score double, predicted int, n_hits long, n_misspelt long, n_quoted long", work,
    )
    return out.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", "predicted",
                      "n_hits", "n_misspelt", "n_quoted")


def keep(docs: DataFrame, model: dict) -> DataFrame:
    """The documents that aren't predicted toxic, with all their columns, in place; no shuffle."""
    import pyarrow as pa

    terms, weights = model["terms"], np.asarray(model["weights"])
    shared = docs.sparkSession.sparkContext.broadcast((terms, frozenset(model["skip"])))
    at = docs.columns.index("text")

    def run(batches):
        reader = Reader(Matcher(*shared.value, wide=True))
        for batch in batches:
            found = [hits(reader, t or "") for t in batch.column(at).to_pylist()]
            good = [float(np.dot(features(n, f, terms), weights)) < 0 for n, f in found]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
