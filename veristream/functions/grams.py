"""Words and pairs of cleaned texts counted as numbers, on Arrow batches in the tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES, PIECE_ROWS = 8_000_000, 1 << 16  # of text counted at a time


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """Runs of texts of ``PIECE_BYTES`` and ``PIECE_ROWS`` at most; a longer text is one alone."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        whole = int(np.searchsorted(ends, (ends[first - 1] if first else 0) + PIECE_BYTES, side="right")) - first
        n = min(max(whole, 1), PIECE_ROWS)
        yield texts.slice(first, n)
        first += n


def words_and_pairs(texts: pa.Array) -> tuple[pa.Array, tuple, tuple]:
    """The words of cleaned texts as ``tokens`` finds them, and (code, row) of every word and of every pair.

    A word's code is its place in the list of words; a pair's is that of its first word times the
    number of words, and that of its second.
    """
    lists = pc.split_pattern(texts, " ")
    flat, row = lists.flatten(), pc.list_parent_indices(lists).to_numpy().astype(np.int64)
    long = pc.greater(pc.utf8_length(flat), 1)
    coded = flat.filter(long).dictionary_encode()
    row, code = row[long.to_numpy(zero_copy_only=False)], coded.indices.to_numpy().astype(np.int64)
    follows = row[1:] == row[:-1]
    return coded.dictionary, (code, row), ((code[:-1] * len(coded.dictionary) + code[1:])[follows], row[1:][follows])


def starts(x: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted values."""
    return np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]])) if len(x) else np.zeros(0, np.int64)


def counted(code: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(code, row, occurrences), once each, ordered by code."""
    shift = PIECE_ROWS.bit_length() - 1
    keys = np.sort((code << shift) | row)
    first = starts(keys)
    return keys[first] >> shift, keys[first] & (PIECE_ROWS - 1), np.diff(first, append=len(keys))


def partial_stats(
    batches: Iterable[pa.RecordBatch], words: bool = True, pairs: bool = True,
    firsts: list[str] | None = None, seconds: list[str] | None = None,
) -> Iterator[pa.RecordBatch]:
    """(copies, text) to (term, total, df), added up over pieces of a batch.

    Of words or of pairs alone where asked; of pairs, those whose words are among ``firsts`` and ``seconds``, if given.
    """
    for batch in batches:
        copies = batch.column(0).to_numpy(zero_copy_only=False)
        for texts in pieces(batch.column(1)):
            weight, copies = copies[: len(texts)], copies[len(texts) :]
            known, single, pair = words_and_pairs(texts)
            if words:
                yield from _sums(known, False, *single, weight)
            if pairs:
                yield from _sums(known, True, *_among(known, *pair, firsts, seconds), weight)


def _among(words: pa.Array, code: np.ndarray, row: np.ndarray, firsts, seconds) -> tuple[np.ndarray, np.ndarray]:
    """The pairs whose first and second word are among these; None stands for any."""
    for wanted, place in ((firsts, lambda c: c // len(words)), (seconds, lambda c: c % len(words))):
        if wanted is not None and len(code):
            known = pc.is_in(words, value_set=pa.array(wanted, pa.string())).to_numpy(zero_copy_only=False)
            kept = known[place(code)]
            code, row = code[kept], row[kept]
    return code, row


def _sums(words: pa.Array, pairs: bool, code: np.ndarray, row: np.ndarray, weight: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(term, total, df) of the words or pairs of a piece."""
    code, row, tf = counted(code, row)
    first = starts(code)
    if len(first):
        of = lambda c: words.take(pa.array(c))
        code = code[first]
        term = pc.binary_join_element_wise(of(code // len(words)), of(code % len(words)), " ") if pairs else of(code)
        sums = [pa.array(np.add.reduceat(x, first)) for x in (tf * weight[row], weight[row])]
        yield pa.RecordBatch.from_arrays([term, *sums], ["term", "total", "df"])


def plain(texts: pa.Array) -> pa.Array:
    """Texts in which a blank, and nothing else, parts the words ``[a-z0-9]+``; null becomes empty."""
    texts = pc.fill_null(texts, "")
    if pc.any(pc.match_substring_regex(texts, "[^a-z0-9 ]")).as_py():
        return pc.replace_substring_regex(texts, "[^a-z0-9]+", " ")
    return texts


class Terms:
    """A vocabulary, at most some ten thousand terms, to find its words and pairs in texts.

    ``terms`` in the order of ``numbers``: what a term is called outside.
    """

    def __init__(self, terms: list[str], numbers: list[int], idf: list[float]):
        self.numbers, self.idf = np.array(numbers, np.int32), np.array(idf, np.float64)
        split = [t.split(" ") for t in terms]
        self.one = [i for i, t in enumerate(split) if len(t) == 1]
        self.two = [i for i, t in enumerate(split) if len(t) == 2]
        self.words = pa.array([terms[i] for i in self.one], pa.string())
        self.firsts = pa.array([split[i][0] for i in self.two], pa.string())
        self.seconds = pa.array([split[i][1] for i in self.two], pa.string())

    def find(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place in the vocabulary, occurrences), once each, ordered by row."""
        words, single, pair = words_and_pairs(texts)
        at = lambda wanted: pc.fill_null(pc.index_in(wanted, value_set=words), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        first, second = at(self.firsts), at(self.seconds)
        here = (first >= 0) & (second >= 0)
        known = [
            (at(self.words), np.array(self.one, np.int64)),
            (np.where(here, first * len(words) + second, -1), np.array(self.two, np.int64)),
        ]
        found = []
        for (codes, places), (code, row) in zip(known, (single, pair)):
            order = np.argsort(codes)
            codes, places = codes[order], places[order]
            slot = np.searchsorted(codes, code)
            hit = slot < len(codes)
            hit[hit] = codes[slot[hit]] == code[hit]
            found.append((places[slot[hit]], row[hit]))
        place, row, tf = counted(*(np.concatenate(x) for x in zip(*found)))
        order = np.argsort(row, kind="stable")
        return row[order], place[order], tf[order]

    def seen(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(text) to (place, seen): in how many texts a term is, added up over pieces of a batch."""
        for batch in batches:
            for texts in pieces(batch.column(0)):
                n = np.bincount(self.find(texts)[1], minlength=len(self.numbers))
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(self.numbers[some]), pa.array(n[some])], ["place", "seen"])

    def weigh(self, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(text_key, text) to (text_key, places, weights): the unit vector of every text that has a term."""
        for batch in batches:
            keys = batch.column(0)
            for texts in pieces(batch.column(1)):
                key, keys = keys.slice(0, len(texts)), keys.slice(len(texts))
                row, place, tf = self.find(texts)
                x = tf * self.idf[place]
                x /= np.sqrt(np.bincount(row, x * x))[row]
                first = starts(row)
                ends = pa.array(np.append(first, len(row)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (self.numbers[place], x)]
                yield pa.RecordBatch.from_arrays([key.take(pa.array(row[first])), *lists], ["text_key", "places", "weights"])


class Vectors(Terms):
    """Texts as unit vectors of weighted counts: what a pipeline of ``features.fit_vectorizer`` makes of them."""

    def __init__(self, terms: list[str], scale: np.ndarray):
        super().__init__(terms, list(range(len(terms))), scale)

    def unit(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, place in the vocabulary, weight), once each, ordered by row and place."""
        row, place, tf = self.find(plain(texts))
        x = tf * self.idf[place]
        x /= np.sqrt(np.bincount(row, x * x, minlength=len(texts)))[row]
        return row, place, x

    def vectors(self, texts: pa.Array) -> pa.Array:
        """Sparse vectors as Spark ML stores them."""
        parts, n = [], 0
        for piece in pieces(texts):
            row, place, x = self.unit(piece)
            parts.append((row + n, place, x))
            n += len(piece)
        row, place, x = (np.concatenate(p) for p in zip(*parts)) if parts else (np.zeros(0, np.int64),) * 3
        ends = pa.array(np.searchsorted(row, np.arange(n + 1)).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (place.astype(np.int32), x.astype(np.float64))]
        sparse, size = pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, len(self.numbers), np.int32))
        return pa.StructArray.from_arrays([sparse, size, *lists], ["type", "size", "indices", "values"])


class Scorer(Vectors):
    """Class probabilities of texts by a linear model over unit vectors of weighted counts."""

    def __init__(self, terms: list[str], scale: np.ndarray, coefficients: np.ndarray, intercepts: np.ndarray):
        super().__init__(terms, scale)
        self.coefficients, self.intercepts = coefficients, intercepts

    def _margins(self, texts: pa.Array) -> np.ndarray:
        row, place, x = self.unit(texts)
        return np.stack([np.bincount(row, x * c[place], minlength=len(texts)) for c in self.coefficients], axis=1) + self.intercepts

    def probabilities(self, texts: pa.Array) -> pa.Array:
        parts = [self._margins(t) for t in pieces(texts)]
        m = np.concatenate(parts) if parts else np.zeros((0, len(self.intercepts)))
        e = np.exp(m - m.max(axis=1, keepdims=True)) if len(m) else m
        p = e / e.sum(axis=1, keepdims=True)
        ends = np.arange(0, p.size + 1, p.shape[1], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(p.ravel()))
