import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.llm.minhash_dedup import band_count, band_keys, least_agreements, min_max, near_duplicates, op12_minhash_dedup
from test_jaccard_join import brute, corpus


def rows(df):
    got = df.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in got if r.doc_id is not None)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str)


@pytest.mark.parametrize("size,t,tile_rows,block_sets", [(3, 85, 2048, 2048), (5, 80, 4, 3)])
def test_against_brute_force(spark, docs_of, size, t, tile_rows, block_sets):
    texts = corpus(random.Random(7 * size))
    docs = docs_of(texts).withColumn("sid", F.lit("x")).withColumn("tile", F.lit(1)).withColumn("kept", F.lit(1))
    assert rows(near_duplicates(docs, size=size, threshold=t, tile_rows=tile_rows, block_sets=block_sets)) == brute(list(enumerate(texts)), size, t)


def test_blocks_by_bytes(spark, docs_of):
    texts = corpus(random.Random(1), 9)
    assert rows(near_duplicates(docs_of(texts), size=3, threshold=85, block_bytes=4000)) == brute(list(enumerate(texts)), 3, 85)


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(op12_minhash_dedup(spark, sf)) == brute(docs, 3, 85)


def test_repeated_null_and_long(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(60_000))
    texts = ["a b c d", "a b c d", "x y z", "a b c d", "x y z q", None, "", long, long + " end"]
    ids = [4, 4, None, 9, None, None, 10, 12, 11]
    assert rows(near_duplicates(docs_of(texts, ids=ids), size=3, threshold=85)) == brute(list(zip(ids, texts)), 3, 85)
    assert near_duplicates(docs_of([])).collect() == []


def test_signatures_are_unbiased_and_vary_less():
    """Agreements estimate the similarity; minima and maxima of k permutations do so at least as well as 2k minima."""
    rng = np.random.default_rng(2)
    k, runs, n = 32, 400, 40
    for share in (0.5, 0.85):
        both, minima, true = [], [], None
        for _ in range(runs):
            u = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            common = round(share * n)
            rest = (n - common) // 2
            a, b = np.sort(u[: common + rest]), np.sort(np.concatenate([u[:common], u[common + rest :]]))
            true = common / n
            v = min_max([a, b], 2 * k)
            both.append((v[0, : 2 * k] == v[1, : 2 * k]).mean())
            minima.append((v[0, ::2] == v[1, ::2]).mean())
        assert abs(np.mean(both) - true) < 0.012 and abs(np.mean(minima) - true) < 0.012
        assert np.var(both) < 1.1 * np.var(minima)


def test_parameters_keep_recall():
    for t in (50, 80, 85, 90):
        b, p = band_count(t), (t / 100) ** 6
        assert (1 - p) ** b <= 1e-9 < (1 - p) ** (b - 1)
    rng = np.random.default_rng(1)
    least = least_agreements(85)
    assert 64 < least < 0.85 * 128 and (rng.binomial(128, 0.85, 1_000_000) >= least).all()
    keys = band_keys(min_max([np.array([1, 2, 3], np.uint64), np.array([3, 4, 9], np.uint64), np.array([1, 2, 3], np.uint64)], 6), 2)
    assert (keys[0] == keys[2]).all() and len(np.unique(keys)) == 4
