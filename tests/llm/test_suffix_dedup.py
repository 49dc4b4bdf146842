import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fareline.llm.suffix_dedup import LONGEST, WINDOW, _distinct, op2_suffix_dedup, remove_repeats, segments, window_classes


def brute(docs):
    low = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - WINDOW + 1):
            s = b[k : k + WINDOW]
            low[s] = min(low.get(s, float("inf")), float("inf") if i is None else i)
    out = []
    for i, t in docs:
        b = (t or "").encode()
        gone = [False] * len(b)
        for k in range(len(b) - WINDOW + 1):
            if low[b[k : k + WINDOW]] < (float("inf") if i is None else i):
                gone[k : k + WINDOW] = [True] * WINDOW
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()), key=str)


def corpus(seed):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcdeéß", k=rnd.randrange(1, 7)))
    passages = [" ".join(word() for _ in range(rnd.randrange(8, 40))) for _ in range(6)] + ["x" * 130, "ab" * 90, "z" * 49, "y" * 50]
    out = [None, "", "short", "x" * 200, "ab" * 70]
    for _ in range(60):
        parts = [rnd.choice(passages) if rnd.random() < 0.4 else " ".join(word() for _ in range(rnd.randrange(30))) for _ in range(rnd.randrange(1, 6))]
        out.append(rnd.choice([" ", "\n", ""]).join(parts))
    out += rnd.choices(out, k=12)
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("seed,more", [(1, {}), (2, {"run_bytes": 900, "segments_per_range": 7}), (3, {"run_bytes": 2000, "hot_docs": 4, "segments_per_range": 20}), (4, {"hot_docs": 2})])
def test_against_brute_force(spark, docs_of, seed, more):
    texts = corpus(seed)
    df = docs_of(texts).withColumn("run", F.lit(1)).withColumn("range", F.lit("x"))
    want = brute(list(enumerate(texts)))
    assert rows(remove_repeats(df, **more)) == want and sum(r[2] for r in want) > 1000


def test_null_and_repeated_ids(spark, docs_of):
    p = "the quick brown fox jumps over the lazy dog and runs away from it all"
    texts = [p, p + " a", "b " + p, p, p, None]
    ids = [7, 7, None, None, 3, 9]
    assert rows(remove_repeats(docs_of(texts, ids=ids))) == brute(list(zip(ids, texts)))


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(op2_suffix_dedup(spark, sf)) == brute(docs)


def test_long_text_and_empty_table(spark, docs_of):
    long = " ".join(str(i * i) for i in range(60_000))
    got = rows(remove_repeats(docs_of([long, "q" + long, "w"]), ))
    assert [(r[0], r[2], r[3]) for r in got] == [(0, 0, 0), (1, len(long), 1), (2, 0, 0)]
    assert rows(remove_repeats(docs_of([]))) == []


@settings(max_examples=150, deadline=None)
@given(st.lists(st.binary(min_size=WINDOW, max_size=LONGEST).map(lambda b: bytes(x % 2 for x in b)), min_size=1, max_size=8), st.integers(0, 3))
def test_classes_are_the_equal_windows(strings, copies):
    strings = strings + [s[1:] + b"\x01" for s in strings[:copies]]
    size = np.array([len(s) for s in strings])
    mat = np.zeros((len(strings), LONGEST), np.uint8)
    for i, s in enumerate(strings):
        mat[i, : len(s)] = np.frombuffer(s, np.uint8)
    one, number = _distinct(mat, size)
    assert len(one) == len(set(strings)) and [strings[one[k]] for k in number] == strings
    i, a, c = window_classes(mat[one], size[one])
    assert len(i) == sum(len(strings[k]) - WINDOW + 1 for k in one)
    windows = [strings[one[x]][y : y + WINDOW] for x, y in zip(i, a)]
    assert len(set(c.tolist())) == len(set(windows)) == len(set(zip(windows, c.tolist())))


def test_segments_cover_all_windows_once():
    rng = np.random.default_rng(4)
    buf = rng.integers(0, 3, 400_000).astype(np.uint8)
    offs = np.array([0, 10, 59, 109, 109, 300_000, 400_000])
    first, last, at, doc = segments(buf, offs)
    covered = np.concatenate([np.arange(a, z + 1) for a, z in zip(first, last)])
    want = np.concatenate([np.arange(a, z - WINDOW + 1) for a, z in zip(offs[:-1], offs[1:]) if z - a >= WINDOW])
    assert (covered == want).all() and (last - first).max() < LONGEST - WINDOW + 1
    assert ((at >= last) & (at + 20 <= first + WINDOW)).all() and (offs[doc] <= first).all()
