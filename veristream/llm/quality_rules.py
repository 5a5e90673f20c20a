"""Quality by labelling lines: a linear-chain CRF over the lines of a document.

Each line gets features (symbols, capitals, repeats, list marks ...); emission weights and
transitions of a two-state chain (boilerplate, content) are fitted on a bounded sample of
documents with a quality label, by Viterbi training: first every line takes its document's
label, then lines are relabelled by decoding and the weights fitted again.  A document stays
when the decoded content lines hold at least ``share`` of its words and the fixed base rules
do not fail it.

Nulls count as empty texts.  Texts without words fail the base rules.  Repeated rows and ids
are kept, a row each; whole texts are read.  Rows of the label table without a label, or
without a document, are not used; with no usable label (or only one class) all lines count
as content.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from veristream.llm.common import WordHash, mix64, per_text, runs

WINDOW = 8
SYMBOLS = b"#*$%&|<>"
FEATURES = (
    "bias", "short", "middle", "symbols", "capitals", "digits", "bars", "shouts", "repeated_line",
    "repeated_windows", "same_as_before", "word_length",
)

#: Sign classes of a byte: blank, symbol, capital, digit, bar, exclamation mark, small letter.
_CLASS = np.zeros(256, np.uint8)
_CLASS[[32, *range(9, 14)]] = 1
_CLASS[[*SYMBOLS]] = 2
_CLASS[65:91] = 3
_CLASS[48:58] = 4
_CLASS[33] = 6
_CLASS[97:123] = 7


def measure(texts: list[str], hashes: WordHash) -> dict:
    """Counts of every text and features of its lines; all texts together on arrays.

    Lines are the pieces between line feeds that hold a word.
    """
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    lines_of, line_doc, line_words, line_dup, words = [], [], [], [], []
    n_dup, line_start, line_stop, base = [0] * len(raw), [], [], 0
    for d, r in enumerate(raw):
        seen, at = set(), base
        for line in r.split(b"\n"):
            some = line.split()  # of bytes: at ASCII white space only, as words are defined
            if some:
                words += some
                again = line in seen
                n_dup[d] += again
                seen.add(line)
                line_doc.append(d)
                line_words.append(len(some))
                line_dup.append(again)
                line_start.append(at)
                line_stop.append(at + len(line))
            at += len(line) + 1
        base += len(r) + 1
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    kind = _CLASS[data]
    size = np.array([len(r) + 1 for r in raw])
    doc_stop = np.cumsum(size)
    doc_start = doc_stop - size
    line_doc, n_line = np.array(line_doc, np.int64), np.array(line_words, np.int64)
    line_start, line_stop = np.array(line_start, np.int64), np.array(line_stop, np.int64)

    def count(mask, start, stop):
        total = np.concatenate([[0], np.cumsum(mask, dtype=np.int32)])
        return (total[stop] - total[start]).astype(np.int64)

    letters = count((data & 0xC0) != 0x80, doc_start, doc_stop - 1)  # code points
    blanks = count(kind == 1, doc_start, doc_stop - 1)
    symbol = kind == 2
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    n_words = np.bincount(line_doc, n_line, len(raw)).astype(np.int64)
    word_doc = np.repeat(np.arange(len(raw)), n_words)
    in_repeat = repeated(h, word_doc)
    line_of_word = np.repeat(np.arange(len(n_line)), n_line)
    per_line = lambda x: np.bincount(line_of_word, x, len(n_line))
    same = np.zeros(len(h), bool)
    same[1:] = (h[1:] == h[:-1]) & (line_of_word[1:] == line_of_word[:-1])
    of = lambda k: count(kind == k, line_start, line_stop)
    capital, small = of(3), of(7)
    width = np.maximum(1, line_stop - line_start)
    x = np.empty((len(n_line), len(FEATURES)))
    x[:, 0] = 1
    x[:, 1] = n_line <= 3
    x[:, 2] = (n_line > 3) & (n_line <= 8)
    x[:, 3] = np.minimum(1, count(symbol, line_start, line_stop) / np.maximum(n_line, 1))
    x[:, 4] = capital / np.maximum(1, capital + small)
    x[:, 5] = of(4) / width
    x[:, 6] = np.minimum(1, 2 * count(data == ord("|"), line_start, line_stop) / np.maximum(n_line, 1))
    x[:, 7] = np.minimum(1, of(6) / np.maximum(n_line, 1))
    x[:, 8] = np.array(line_dup, bool)
    x[:, 9] = per_line(in_repeat) / np.maximum(n_line, 1)
    x[:, 10] = per_line(same) / np.maximum(n_line, 1)
    x[:, 11] = np.minimum(2, width / np.maximum(n_line, 1) / 10)
    return {
        "n_words": n_words, "word_chars": letters - blanks, "n_symbols": count(symbol, doc_start, doc_stop - 1),
        "n_dup_lines": np.array(n_dup, np.int64),
        "n_repeat_words": np.bincount(word_doc, in_repeat, len(raw)).astype(np.int64),
        "x": x, "line_doc": line_doc, "line_words": n_line,
    }


def repeated(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Which words stand in a window of 8 that occurs twice or more in their document."""
    out = np.zeros(len(h), bool)
    if len(h) < WINDOW:
        return out
    window = mix64(runs(h, WINDOW) + doc[: 1 - WINDOW].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    whole = np.flatnonzero(doc[: 1 - WINDOW] == doc[WINDOW - 1 :])
    window = window[whole]
    order = np.argsort(window)
    equal = window[order][1:] == window[order][:-1]
    twice = np.zeros(len(window), bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    edge = np.zeros(len(h) + 1, np.int64)
    np.add.at(edge, whole[twice], 1)
    np.add.at(edge, whole[twice] + WINDOW, -1)
    return np.cumsum(edge[:-1]) > 0


# --- the chain ---------------------------------------------------------------


def viterbi(score: list[float], model: dict) -> list[int]:
    """Best states of one document's lines; ``score``: of content against boilerplate, per line."""
    (stay0, go1), (go0, stay1) = model["transitions"]
    a, b, back = 0.0, 0.0, []
    for k, s in enumerate(score):
        if k:
            from0, from1 = (a + stay0, b + go0), (a + go1, b + stay1)
            back.append((from0[1] > from0[0], from1[1] >= from1[0]))
            a, b = max(from0), max(from1)
        b += s
    state = int(b >= a)
    out = [state]
    for pointers in reversed(back):
        state = int(pointers[state])
        out.append(state)
    return out[::-1]


def decode(x: np.ndarray, line_doc: np.ndarray, n: int, model: dict) -> np.ndarray:
    """State of every line (1: content)."""
    score = (x @ np.asarray(model["weights"])).tolist()
    cut = np.searchsorted(line_doc, np.arange(n + 1)).tolist()
    return np.array([s for a, b in zip(cut[:-1], cut[1:]) if b > a for s in viterbi(score[a:b], model)], np.int64)


#: Used when there is nothing to learn from: everything is content.
PLAIN = {"weights": [1.0] + [0.0] * (len(FEATURES) - 1), "transitions": [[0.0, 0.0], [0.0, 0.0]]}


def fit_chain(x: np.ndarray, line_doc: np.ndarray, label: np.ndarray, rounds: int = 3) -> dict:
    """Weights from lines whose documents' labels are known.

    Lines of good documents stay content; lines of bad ones may be found to be content by
    decoding.  Emissions: ridge logistic regression by Newton steps; transitions: smoothed
    counts.
    """
    if len(x) == 0 or label.min() == label.max():
        return PLAIN
    y = label[line_doc].astype(float)
    weight = 1 / np.bincount(line_doc, minlength=len(label))[line_doc]  # each document counts once
    model = {"transitions": [[0.0, 0.0], [0.0, 0.0]]}
    for _ in range(rounds):
        w = np.zeros(x.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            gradient = x.T @ (weight * (y - p)) - 0.5 * w
            hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.5 * np.eye(len(w))
            step = np.linalg.solve(hessian, gradient)
            w = w + step
            if np.abs(step).max() < 1e-6:
                break
        model["weights"] = w.tolist()
        state = decode(x, line_doc, len(label), model)
        y = np.where(label[line_doc] == 1, 1, state).astype(float)
        within = line_doc[1:] == line_doc[:-1]
        counts = np.ones((2, 2))
        np.add.at(counts, (y[:-1][within].astype(int), y[1:][within].astype(int)), 1)
        model["transitions"] = np.log(counts / counts.sum(1, keepdims=True)).tolist()
    return model


def held_out(key: Column) -> Column:
    """The fifth of the labels that no model sees."""
    return F.crc32(key.cast("string")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4000) -> dict:
    """The chain, from at most ``sample`` labelled documents outside the held-out fifth.

    Half of them are of each class where there are as many; which ones is decided by a
    hash of the id.  They are found in the tasks; what comes to the driver is their lines'
    features, bounded by the sample.
    """
    known = labels.select(F.col("doc_id").alias("id"), F.col("quality").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("id"))
    )
    parts = [
        known.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(sample // 2) for y in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1]).groupBy("id").agg(F.min("y").alias("y"))
    texts = docs.select(F.col("doc_id").alias("id"), "text").join(F.broadcast(chosen), "id")

    def work():
        hashes = WordHash()

        def step(keys, some):
            m = measure(some, hashes)
            cut = np.searchsorted(m["line_doc"], np.arange(len(some) + 1))
            return {"id": keys, "lines": [m["x"][a:b].ravel().tolist() for a, b in zip(cut[:-1], cut[1:])]}

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = per_text(texts, "id", "text", f"id {kind}, lines array<double>", work).join(F.broadcast(chosen), "id").collect()
    rows = sorted((r for r in rows if r["lines"]), key=lambda r: (r["id"], r["lines"]))
    x = [np.array(r["lines"]).reshape(-1, len(FEATURES)) for r in rows]
    if not x:
        return PLAIN
    line_doc = np.repeat(np.arange(len(x)), [len(a) for a in x])
    return fit_chain(np.concatenate(x), line_doc, np.array([r["y"] for r in rows]))


def judge(docs: DataFrame, model: dict, share: float = 0.5, min_words: int = 20, max_repeat: int = 30) -> DataFrame:
    """Counts, verdicts and the share of words in content lines, for every document."""

    def work():
        hashes = WordHash()

        def step(keys, texts):
            m = measure(texts, hashes)
            state = decode(m["x"], m["line_doc"], len(texts), model)
            content = np.bincount(m["line_doc"], m["line_words"] * state, len(texts))
            part = content / np.maximum(1, m["n_words"])
            failed = (m["n_words"] < min_words) | (100 * m["n_repeat_words"] > max_repeat * m["n_words"])
            counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            return {
                "doc_id": keys, **{c: m[c] for c in counts}, "base_failed": failed,
                "kept": ~failed & (part >= share), "content_share": part,
            }

        return step

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_text(
        docs, "doc_id", "text",
        f"doc_id {kind}, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "base_failed boolean, kept boolean, content_share double", work,
    )
