"""BPE encoding and decoding: speculate and verify.

Greedy longest match proposes tokens for each word.  A row of tokens is what the
merge rules give exactly when every two neighbours are *compatible*, that is when
no rule would have joined across their border; all borders of a batch are tested at
once on arrays.  Only words with a failing border go through the merge rules.  A proposal takes a
round for each byte of the longest word, so words of over a thousand bytes go to the rules at once.

Nulls count as empty texts; empty texts have no tokens.  Repeated rows, repeated ids
and null ids are kept, a row each.  Texts and words of any length are encoded whole.  Other columns
are not looked at.
"""

from __future__ import annotations

import gc
import heapq
import json

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Regex, normalizers, pre_tokenizers

from veristream.llm.common import per_text, sha

END = "</w>"
#: Fixed value: the separators that the tokenizer's expression takes as white space.
BLANK = r"\t-\r \x85\xa0  -     　"
SPLIT_AT = regex.compile(f"[{BLANK}]+")
#: Python's split() also takes these four, the tokenizer doesn't.
ODD_BLANK = regex.compile(r"[\x1c-\x1f]")
#: Beyond Latin letters, what is a letter depends on the version of Unicode: such strings are cut into words by the
#: tokenizer library's own expression engine.  (Below, all versions agree and nothing composes.)
UNUSUAL = regex.compile(r"[^\x00-\u024f]").search
#: Words remembered by a task, and as many of before; those in use are carried on, the rest are forgotten.
REMEMBERED = 50_000
#: Characters encoded at a time.
CHARS = 500_000
#: Bytes of a word beyond which it is merged by itself.
LONG = 64
#: Bytes of a word above which nothing is proposed for it.
VERY_LONG = 1024
NO_RANK = np.int64(1) << 40
NO_RULE = np.int64(1) << 62


def read_spec(path: str) -> dict:
    """The parts of a tokenizer file that encoding needs; checks that it is of the kind built here."""
    with open(path, encoding="utf-8") as f:
        d = json.load(f)
    model, steps = d["model"], d["pre_tokenizer"]["pretokenizers"]
    if model["end_of_word_suffix"] != END or steps[1]["type"] != "ByteLevel" or d["decoder"]:
        raise ValueError(f"{path} is not a byte-level BPE with word ends")
    return {
        "vocab": model["vocab"],
        "merges": [tuple(m) for m in model["merges"]],
        "pattern": steps[0]["pattern"]["Regex"],
        "added": {t["content"]: t["id"] for t in d["added_tokens"]},
    }


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself where printable, else from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Lookup:
    """Whole numbers to whole numbers for arrays at once: open addressing in a half-empty table."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.shift = np.uint64(64 - int(np.ceil(np.log2(max(4, 4 * len(keys))))))
        size = 1 << (64 - int(self.shift))
        self.keys, self.values, self.size = np.full(size, -1, np.int64), np.full(size, -1, np.int64), size
        todo, slot = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.keys[slot[todo]] < 0
            at, first = np.unique(slot[todo[free]], return_index=True)
            won = todo[free][first]
            self.keys[at], self.values[at] = keys[won], values[won]
            todo = todo[self.keys[slot[todo]] != keys[todo]]
            slot[todo] = (slot[todo] + 1) % size

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The values, -1 where there is none."""
        slot = self._slot(keys)
        found = self.keys[slot]
        out = np.where(found == keys, self.values[slot], -1)
        todo = np.flatnonzero((found != keys) & (found >= 0))
        while len(todo):
            slot[todo] = (slot[todo] + 1) % self.size
            found = self.keys[slot[todo]]
            hit = found == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return out


class Bpe:
    def __init__(self, spec: dict):
        self.vocab: dict[str, int] = spec["vocab"]
        self.added: dict[str, int] = spec["added"]
        self.words = regex.compile(spec["pattern"].replace(r"\s", BLANK)).findall
        self.split = pre_tokenizers.Split(Regex(spec["pattern"]), "removed", invert=True)
        self.normal = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.added)) + ")") if self.added else None
        n = max([*self.vocab.values(), *self.added.values()]) + 1
        self.token = [""] * n
        for t, i in [*self.vocab.items(), *self.added.items()]:
            self.token[i] = t
        letters = byte_letters()
        self.inner = np.array([self.vocab[c] for c in letters], np.int64)
        self.last = np.array([self.vocab[c + END] for c in letters], np.int64)
        self.left, self.right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        self.rank = np.full(n, -1, np.int64)  # of the rule that makes the token
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        for r, (a, b) in enumerate(spec["merges"]):
            x, y, z = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.rules.setdefault((x, y), (r, z))
            if self.rank[z] < 0:
                self.rank[z], self.left[z], self.right[z] = r, x, y
        pairs = np.array([x << 32 | y for x, y in self.rules], np.int64)
        self.rule = Lookup(pairs, np.array([r << 32 | z for r, z in self.rules.values()], np.int64))
        self._build_trie({c: b for b, c in enumerate(letters)})
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        self.checked = self.failed = 0

    def _build_trie(self, byte: dict[str, int]) -> None:
        """All tokens byte by byte; sign 256 stands for the word end."""
        child: dict[int, int] = {}
        made, nodes = {}, 1
        for token, i in self.vocab.items():
            if i in self.added.values():
                continue
            end = token.endswith(END)
            node = 0
            for sign in [*map(byte.get, token[: -len(END)] if end else token), *[256] * end]:
                key = node << 9 | sign
                if key not in child:
                    child[key] = nodes
                    nodes += 1
                node = child[key]
            made[node] = i
        self.made = np.full(nodes, -1, np.int64)
        self.made[list(made)] = list(made.values())
        self.child = Lookup(np.array(list(child), np.int64), np.array(list(child.values()), np.int64))

    # --- the steps ---

    def propose(self, flat: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Greedy longest match for all words together: (word, token), in order.

        Every word walks down the trie at its own position; one that gets stuck gives
        out the longest token that it has passed and begins anew behind it.
        """
        live = np.arange(len(start))
        at, node = start.copy(), np.zeros(len(start), np.int64)
        best, best_end = np.full(len(start), -1, np.int64), start.copy()
        out_word, out_token = [], []
        while len(live):
            inside = at[live] < stop[live]
            down = np.full(len(live), -1, np.int64)
            i = live[inside]
            down[inside] = self.child.get(node[i] << 9 | flat[at[i]])
            moved = down >= 0
            i, to = live[moved], down[moved]
            node[i] = to
            at[i] += 1
            token = self.made[to]
            ends = at[i] == stop[i]
            closing = self.child.get(to[ends] << 9 | 256)
            token[ends] = np.where(closing >= 0, self.made[closing], -1)
            has = token >= 0
            best[i[has]], best_end[i[has]] = token[has], at[i[has]]
            i = live[~moved]
            out_word.append(i)
            out_token.append(best[i])
            at[i], node[i], best[i] = best_end[i], 0, -1
            live = np.concatenate([live[moved], i[best_end[i] < stop[i]]])
        word, token = np.concatenate(out_word), np.concatenate(out_token)
        order = np.argsort(word, kind="stable")
        return word[order], token[order]

    def compatible(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """For each pair of tokens: would both come out unchanged, side by side?

        Goes back in time from the finished tokens.  Of the two tokens that touch,
        the one made last is taken apart: a left one leaves its right half at the
        border, a right one its left half.  A rule for the two that touch would have
        joined them if it came before the rules that made the next larger left one
        (ties go left to right, so strictly) and right one.
        """
        x, y = a.astype(np.int64), b.astype(np.int64)
        good = np.ones(len(x), bool)
        until_x, until_y = np.full(len(x), NO_RANK), np.full(len(x), NO_RANK)
        live = np.arange(len(x))
        while len(live):
            found = self.rule.get(x[live] << 32 | y[live])
            rule = np.where(found >= 0, found >> 32, NO_RANK)
            joined = (rule < until_x[live]) & (rule <= until_y[live]) & (rule < NO_RANK)
            good[live[joined]] = False
            live = live[~joined]
            rx, ry = self.rank[x[live]], self.rank[y[live]]
            made = (rx >= 0) | (ry >= 0)
            live, rx, ry = live[made], rx[made], ry[made]
            back_y = ry >= rx
            i = live[back_y]
            until_y[i], y[i] = ry[back_y], self.left[y[i]]
            i = live[~back_y]
            until_x[i], x[i] = rx[~back_y], self.right[x[i]]
        return good

    def merge(self, rows: np.ndarray) -> np.ndarray:
        """The merge rules on many words of like length: lowest rank first, leftmost among equals.

        ``rows`` holds single-byte tokens, -1 behind the end of each word.
        """
        ids, n = rows.copy(), rows.shape[1]
        live, column = np.arange(len(ids)), np.arange(n)
        found = self._rules(ids)
        while len(live):
            part = found[live]
            j = part.argmin(1)
            rule = part[np.arange(len(live)), j]
            some = rule < NO_RULE
            live, j, rule = live[some], j[some], rule[some]
            if not len(live):
                break
            shift = column + (column > j[:, None])
            row = np.pad(ids[live], ((0, 0), (0, 1)), constant_values=-1)
            row[np.arange(len(live)), j] = rule & 0xFFFFFFFF
            ids[live] = row = np.take_along_axis(row, shift, 1)
            part = np.pad(found[live], ((0, 0), (0, 1)), constant_values=NO_RULE)
            part = np.take_along_axis(part, shift[:, : n - 1], 1)
            k = np.arange(len(live))
            right = np.minimum(j, n - 2)
            part[k, right] = self._rules(row[k[:, None], right[:, None] + [0, 1]])[:, 0]
            left = np.maximum(j - 1, 0)
            part[k, left] = self._rules(row[k[:, None], left[:, None] + [0, 1]])[:, 0]
            found[live] = part
        return ids

    def _rules(self, ids: np.ndarray) -> np.ndarray:
        a, b = ids[:, :-1], ids[:, 1:]
        found = self.rule.get(np.where((a >= 0) & (b >= 0), a << 32 | b, -2).ravel()).reshape(a.shape)
        return np.where(found >= 0, found, NO_RULE)

    def merge_long(self, raw: bytes) -> list[int]:
        """The same for one long word, with a heap."""
        codes = np.frombuffer(raw, np.uint8)
        ids: list = [*self.inner[codes[:-1]].tolist(), int(self.last[codes[-1]])]
        after, before = [*range(1, len(ids)), -1], [-1, *range(len(ids) - 1)]
        heap = [(r, i, z) for i in range(len(ids) - 1) for r, z in [self.rules.get((ids[i], ids[i + 1]), (-1, 0))] if r >= 0]
        heapq.heapify(heap)
        while heap:
            r, i, z = heapq.heappop(heap)
            j = after[i]
            if ids[i] is None or j < 0 or self.rules.get((ids[i], ids[j])) != (r, z):
                continue
            ids[i], ids[j] = z, None
            after[i] = k = after[j]
            h = before[i]
            if k >= 0:
                before[k] = i
                if (z, ids[k]) in self.rules:
                    r, new = self.rules[z, ids[k]]
                    heapq.heappush(heap, (r, i, new))
            if h >= 0 and (ids[h], z) in self.rules:
                r, new = self.rules[ids[h], z]
                heapq.heappush(heap, (r, h, new))
        return [t for t in ids if t is not None]

    # --- words and texts ---

    def encode_words(self, raw: list[bytes]) -> list[bytes]:
        """Ids (little-endian, 4 bytes each) of each word, given as its bytes."""
        if not raw:
            return []
        lengths = np.array([len(r) for r in raw], np.int64)
        if lengths.max() > VERY_LONG:
            rest = iter(self.encode_words([r for r in raw if len(r) <= VERY_LONG]))
            return [np.asarray(self.merge_long(r), "<u4").tobytes() if len(r) > VERY_LONG else next(rest) for r in raw]
        flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
        stop = np.cumsum(lengths)
        word, token = self.propose(flat, stop - lengths, stop)
        border = np.flatnonzero(word[1:] == word[:-1])
        failing = np.unique(word[border[~self.compatible(token[border], token[border + 1])]])
        self.checked += len(raw)
        self.failed += len(failing)
        cut = np.searchsorted(word, np.arange(len(raw) + 1)) * 4
        data = token.astype("<u4").tobytes()
        out = [data[a:b] for a, b in zip(cut[:-1].tolist(), cut[1:].tolist())]
        for low, high in ((0, 6), (6, 10), (10, 16), (16, 32), (32, LONG)):
            some = failing[(lengths[failing] > low) & (lengths[failing] <= high)]
            if len(some):
                place = np.arange(min(high, lengths[some].max()))
                here = place < lengths[some][:, None]
                codes = flat[np.where(here, (stop - lengths)[some][:, None] + place, 0)]
                rows = np.where(here, self.inner[codes], -1)
                end = np.arange(len(some)), lengths[some] - 1
                rows[end] = self.last[codes[end]]
                rows = self.merge(rows)
                data, counts = rows[rows >= 0].astype("<u4").tobytes(), (rows >= 0).sum(1)
                cut = np.concatenate([[0], np.cumsum(counts)]) * 4
                for i, a, b in zip(some.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
                    out[i] = data[a:b]
        for i in failing[lengths[failing] > LONG]:
            out[i] = np.asarray(self.merge_long(raw[i]), "<u4").tobytes()
        return out

    def learn(self, chunks: list[str]) -> None:
        """Remember the ids of strings without blanks."""
        parts = []
        for c in chunks:
            if c.isascii() and c.isalpha():
                parts.append([c.lower()])
            elif not c.isascii() and UNUSUAL(c):
                parts.append([w for w, _ in self.split.pre_tokenize_str(self.normal.normalize_str(c))])
            else:
                parts.append(self.words(c.lower()))
        distinct = list({w for p in parts for w in p})
        ids = dict(zip(distinct, self.encode_words([w.encode("utf-8", "replace") for w in distinct])))
        for c, p in zip(chunks, parts):
            self.known[c] = ids[p[0]] if len(p) == 1 else b"".join([ids[w] for w in p])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian, 4 bytes each."""
        gc.disable()  # a million strings make no cycles, but looking for some takes long
        try:
            return self._encode(texts)
        finally:
            gc.enable()

    def _encode(self, texts: list[str]) -> list[bytes]:
        rows = []
        for t in texts:
            if self.specials and "<|" in t:
                pieces = self.specials.split(t)
                rows.append([c for k, p in enumerate(pieces) for c in ([p] if k % 2 else self._chunks(p))])
            else:
                rows.append(self._chunks(t))
        if len(self.known) > REMEMBERED:
            self.known, self.before = {}, self.known
        for s, i in self.added.items():
            self.known[s] = np.asarray([i], "<u4").tobytes()
        known = self.known
        new = {c for r in rows for c in r if c not in known}
        old = new & self.before.keys()
        if old:
            known.update((c, self.before[c]) for c in old)
            new -= old
        if new:
            self.learn(list(new))
        return [b"".join([known[c] for c in r]) for r in rows]

    @staticmethod
    def _chunks(text: str) -> list[str]:
        return [c for c in SPLIT_AT.split(text) if c] if ODD_BLANK.search(text) else text.split()

    def decode(self, ids: bytes) -> str:
        """The tokens joined by blanks, as the tokenizer's file names no decoder."""
        token = self.token
        return " ".join([token[i] for i in np.frombuffer(ids, "<u4").tolist()])


_LOADED: dict[str, Bpe] = {}


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ids and decoded text of every text, without special tokens added.

    The vocabulary file is read once, by the driver, and sent to the tasks; its size
    does not grow with the data.
    """
    return _apply(docs, path, key, text, f"`{key}` {_type(docs, key)}, ids binary, decoded string",
                  lambda bpe, k, e: {key: k, "ids": e, "decoded": [bpe.decode(i) for i in e]})


def digests(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, number of tokens and SHA-256 of ids and of the decoded text."""
    return _apply(
        docs, path, key, text, f"`{key}` {_type(docs, key)}, n_tokens long, ids_sha256 string, decoded_sha256 string",
        lambda bpe, k, e: {
            key: k, "n_tokens": [len(i) // 4 for i in e], "ids_sha256": [sha(i) for i in e],
            "decoded_sha256": [sha(bpe.decode(i)) for i in e],
        },
    )


def _type(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def _apply(docs, path, key, text, schema, columns):
    context = docs.sparkSession.sparkContext
    spec, name = context.broadcast(read_spec(path)), f"{context.applicationId} {path}"

    def work():
        if name not in _LOADED:  # a worker process serves many tasks
            _LOADED.clear()
            _LOADED[name] = Bpe(spec.value)
        bpe = _LOADED[name]
        return lambda keys, texts: columns(bpe, keys, bpe.encode(texts))

    return per_text(docs, key, text, schema, work, CHARS)
