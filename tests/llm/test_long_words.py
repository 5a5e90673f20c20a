"""Words of any length equal the library's, in time that grows with the length."""

import random
import time

import numpy as np
import pytest
from tokenizers import Tokenizer

from veristream.llm import bpe
from veristream.llm.queries import bpe_path


@pytest.mark.parametrize("kind", ["letters", "base64", "same"])
def test_very_long_words(kind):
    r = random.Random(kind)
    alphabet = {"letters": "abcdefghijklmnopqrstuvwxyz", "base64": "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "same": "a"}[kind]
    library = Tokenizer.from_file(bpe_path())
    library.no_truncation()
    coder = bpe.Bpe(bpe.read_spec(bpe_path()))
    texts = ["one " + "".join(r.choice(alphabet) for _ in range(n)) + " two" for n in (1000, 1023, 1024, 1025, 5000, 60_000)]
    want = [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    started = time.perf_counter()
    assert coder.encode(texts) == want
    assert time.perf_counter() - started < 20


def test_remembered_words_are_bounded():
    library = Tokenizer.from_file(bpe_path())
    library.no_truncation()
    coder = bpe.Bpe(bpe.read_spec(bpe_path()))
    for part in range(12):
        texts = [" ".join(f"the word{part}q{k}z{i}" for i in range(1000)) for k in range(12)]
        got = coder.encode(texts)
        assert got[0] == np.array(library.encode(texts[0], add_special_tokens=False).ids, "<u4").tobytes()
    assert len(coder.known) + len(coder.before) < 100_000
