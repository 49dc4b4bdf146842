import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fareline.llm import common
from fareline.llm.common import ALNUM_WORD, SPACE_SPLIT, document_words, mix64

PATTERNS = [(SPACE_SPLIT, r"[^\x20\x09-\x0D]+"), (ALNUM_WORD, r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")]


def hash_of(word):
    """The word hash restated in plain integers."""
    top, total = 1 << 64, 0
    for i, b in enumerate(word.encode()):
        b += 32 if 65 <= b <= 90 else 0
        f = int(mix64(np.array([(i + 1) * 0x9E3779B97F4A7C15 % top], np.uint64))[0])
        total = (total + f * (b + 1)) % top
    return int(mix64(np.array([total], np.uint64))[0])


@pytest.mark.parametrize("piece", [1, 2, 7, 64, 4 << 20])
@pytest.mark.parametrize("table,pattern", PATTERNS)
def test_words_in_pieces(monkeypatch, piece, table, pattern):
    monkeypatch.setattr(common, "PIECE_BYTES", piece)
    rnd = random.Random(piece)
    texts = [None, "", " ", "a", "é", "ab", "cd", *("".join(rnd.choice("aBé1 .\n🎉") for _ in range(rnd.randrange(60))) for _ in range(60))]
    got = []
    for first, last, w in document_words(pa.array(texts), table, target=50):
        data = [t.encode() if t else b"" for t in texts[first:last]]
        whole = b"".join(data)
        for d in range(w.n_docs):
            got.append([(whole[s:e].decode(), int(h)) for s, e, h in zip(*(x[w.first[d] : w.first[d + 1]] for x in (w.starts, w.ends, w.hash)))])
            assert (w.doc[w.first[d] : w.first[d + 1]] == d).all()
    assert got == [[(x, hash_of(x)) for x in re.findall(pattern, t or "")] for t in texts]


def test_long_text_and_long_word(monkeypatch):
    plain = [hash_of("x" * 300), hash_of("y")]
    monkeypatch.setattr(common, "PIECE_BYTES", 100)
    (_, _, w), = document_words(pa.array(["x" * 300 + " Y"]), SPACE_SPLIT)
    assert w.hash.tolist() == plain
