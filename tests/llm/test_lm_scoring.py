import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from fareline.llm.lm_scoring import LogBloom, count_of, levels, lm_scores, op9_lm_scoring


def tokens(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) + ["</s>"]


def brute(docs):
    held = {k: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for k, (i, _) in enumerate(docs)}
    c = Counter(t for k, (_, x) in enumerate(docs) if not held[k] for t in tokens(x))
    n, v = sum(c.values()), len(c)
    out = []
    for k, (i, x) in enumerate(docs):
        ts = tokens(x)
        out.append((i, held[k], len(ts), sum(c[t] > 0 for t in ts), n, round(sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts), 6)))
    return sorted(out, key=str)


def plain_scores(docs):
    """The model restated in plain loops, with true level counts (no false probes)."""
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in docs]
    words, pairs = Counter(), Counter()
    for (_, x), h in zip(docs, held):
        if not h:
            t = tokens(x)
            words.update(t)
            pairs.update(zip(t, t[1:]))
    n, once = sum(words.values()), sum(c == 1 for c in words.values())

    def quantised(c):
        if not c:
            return 0.0
        level = 1
        while 1.3**level <= c + 1e-9:
            level += 1
        inside = [k for k in range(1, 10 * c + 10) if 1.3 ** (level - 1) <= k + 1e-9 and k < 1.3**level - 1e-9]
        return math.sqrt(inside[0] * inside[-1])

    q = {w: quantised(c) for w, c in words.items()}
    norm, unseen = sum(q.values()), max(once, 1)

    def p(w):
        return n / (n + once) * q[w] / norm if w in q else unseen / (n + unseen) / (once + 1)

    out = []
    for i, x in docs:
        t, total = tokens(x), 0.0
        for k, w in enumerate(t):
            prob = p(w)
            if k and t[k - 1] in q:
                prob = 0.4 * min(1.0, quantised(pairs[t[k - 1], w]) / q[t[k - 1]]) + 0.6 * prob
            total += math.log10(prob)
        out.append((i, round(total, 6)))
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def fold_col():
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5)) == 1


def test_base_against_brute_force_and_model_beats_it(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    df = op9_lm_scoring(spark, sf)
    assert rows(df) == brute(docs)
    held = [r for r in df.collect() if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
    assert all(r.score < 0 and math.isfinite(r.score) for r in held)


def test_scores_against_plain_loops(spark, docs_of):
    """Broadcast or probed by shard, many ranges or one: the same scores, those of the restated model."""
    sf = "/root/testdata/sf0.001"
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(60).collect()] + [None, "", "never seen words", "a b a b a b"]
    docs = docs_of(texts)
    want = plain_scores(list(enumerate(texts)))
    for more in ({}, {"filter_bytes": 0}, {"bucket_entries": 500}, {"filter_bytes": 0, "bucket_entries": 500, "run_bytes": 9000}):
        # so many bits that no probe errs
        got = lm_scores(docs, held_col=fold_col(), bits_per_entry=400, **more).collect()
        assert sorted(((r.doc_id, round(r.score, 6)) for r in got), key=str) == want, more
        assert len({r.filter_bytes for r in got}) == 1 and got[0].filter_bytes > 0
    # with the usual bits a probe errs now and then, always upwards
    usual = {r.doc_id: r.score for r in lm_scores(docs, held_col=fold_col()).collect()}
    off = [usual[i] - s for i, s in want]
    assert abs(float(np.median(off))) < 0.5 and {r.doc_id: r.score for r in lm_scores(docs, held_col=fold_col(), filter_bytes=0).collect()} == usual


def test_nothing_is_dropped(spark, docs_of):
    """A word or pair that occurs once among many others raises its own score."""
    common = ["the cat sat on the mat"] * 3000
    rare = docs_of([*common, "zyx wvu tsr", "zyx wvu tsr", "qqq wvu zyx"])
    got = {r.doc_id: r.score for r in lm_scores(rare, held_col=F.col("doc_id") >= 3001).collect()}
    assert got[3001] == got[3000] > got[3002] + 1


def test_nulls_repeats_small_runs_and_long_text(spark, docs_of):
    texts = [None, "", "A b  a", "a B", "a b", "é É x", "w " * 50_000, "x" * 100_000] * 2
    ids = [1, 2, 3, None, None, 6, 7, 8, 1, 2, 30, 31, 32, 33, 34, 35]
    df = docs_of(texts, ids=ids).withColumn("run", F.lit(1)).withColumn("score", F.lit("s"))
    assert rows(lm_scores(df, held_col=fold_col(), run_bytes=8)) == brute(list(zip(ids, texts)))


def test_empty_table_and_nothing_to_train_on(spark, docs_of):
    assert lm_scores(docs_of([])).collect() == []
    r = lm_scores(docs_of(["a b"]), held_col=F.lit(True)).collect()[0]
    assert (r.n_known, r.train_tokens, r.n_tokens) == (0, 0, 3) and math.isfinite(r.score)


def test_filter_never_underestimates_and_rarely_overestimates():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 62, 20_000).astype(np.uint64)
    counts = np.maximum(1, (1 / rng.random(20_000)).astype(np.int64))
    q = levels(counts)
    bloom = LogBloom.build(keys, q)
    got = bloom.level(keys)
    assert (got >= q).all() and (got == q).mean() > 0.97
    assert (bloom.level(rng.integers(0, 1 << 62, 20_000).astype(np.uint64) | np.uint64(1 << 63)) == 0).mean() > 0.97


def test_levels_hold_their_counts():
    c = np.arange(1, 5000)
    q = levels(c)
    est = count_of(q)
    assert (np.diff(q) >= 0).all() and q[0] == 1 and est[0] == 1.0
    assert (np.abs(np.log(est / c)) <= np.log(1.3) / 2 + 0.15).all()
