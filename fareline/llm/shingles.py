"""Documents as sets of distinct word n-grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from fareline.llm.common import SPACE_SPLIT, Words, document_words, mix64

_PLACE = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]


def shingle_sets(w: Words, size: int):
    """Sorted distinct shingle hashes of each document of a run."""
    n = len(w.hash)
    with np.errstate(over="ignore"):
        rolled = w.hash.copy() if size == 1 else np.zeros(max(n - size + 1, 0), np.uint64)
        if size > 1 and n >= size:
            for k in range(size):
                rolled = mix64(rolled + w.hash[k : n - size + 1 + k] * _PLACE[k % 3])
        for d in range(w.n_docs):
            a, z = w.first[d], w.first[d + 1]
            if z - a >= size:
                yield np.unique(rolled[a : z - size + 1])
            elif z > a:
                h = np.uint64(z - a)
                for x in w.hash[a:z]:
                    h = mix64(np.array([h * _PLACE[1] + x * _PLACE[0]]))[0]
                yield np.array([h])
            else:
                yield np.zeros(0, np.uint64)


def set_id(s: np.ndarray) -> int:
    """64-bit digest of a shingle set."""
    return int(mix64(np.array([mix64(s ^ _PLACE[2]).sum(dtype=np.uint64) + np.uint64(len(s))]))[0].astype(np.int64))


def sets_of_texts(texts: pa.Array, wanted, size: int):
    """Each text's set where it has the wanted digest, else None."""
    for first, _, w in document_words(texts, SPACE_SPLIT):
        for d, s in enumerate(shingle_sets(w, size)):
            yield s if len(s) and set_id(s) == wanted[first + d] else None


def set_arrays(size: int):
    """Set arrays of the wanted ids (text, sid, component, parts); rows of a task with one id give one array."""

    def run(batches):
        seen = set()
        for b in batches:
            wanted = b.column(1).to_pylist()
            for first, _, w in document_words(b.column(0), SPACE_SPLIT):
                rows, out = [], []
                for d, s in enumerate(shingle_sets(w, size)):
                    k = wanted[first + d]
                    if k not in seen and len(s) and set_id(s) == k:
                        seen.add(k)
                        rows.append(first + d)
                        out.append(s.tobytes())
                if rows:
                    at = pa.array(rows)
                    yield pa.record_batch([*(b.column(c).take(at) for c in (1, 2, 3)), pa.array(out, pa.binary())], names=["sid", "component", "parts", "shingles"])

    return run
