import math

import duckdb
import pytest
from pyspark.sql import functions as F

from fareline.llm.mixing import OP5_SQL, find_exponent, mix, op5_mixing


def corpus(spark, sizes, words=20):
    rows, i = [], 0
    for s, n in sizes.items():
        for k in range(n):
            rows.append((i, s, " ".join(["w"] * (words + k % 7))))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("tokens", F.lit("x")).withColumn("epoch", F.lit(1))


def tokens_of(df):
    return {r.source: r.t for r in df.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}


def test_quotas_epochs_and_slots(spark):
    df = corpus(spark, {"a": 400, "b": 90, "c": 10, None: 60})
    out = mix(df, repetition=2.0).cache()
    have = {r.source: (r.t, r.n) for r in df.groupBy("source").agg(F.sum(F.size(F.split("text", " "))).alias("t"), F.count("*").alias("n")).collect()}
    whole = sum(t for t, _ in have.values())
    got = tokens_of(out)
    # the rule by hand: the smallest exponent that repeats no source more than twice
    def repetition(alpha):
        z = sum((t / whole) ** alpha for t, _ in have.values())
        return max((t / whole) ** alpha / z * whole / t for t, _ in have.values())

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if repetition(mid) <= 2 else (mid, high)
    z = sum((t / whole) ** high for t, _ in have.values())
    for s, (t, _) in have.items():
        quota = (t / whole) ** high / z * whole
        assert quota - 1 <= got[s] <= quota + 27, s
    rows = out.collect()
    assert all(0 <= r.slot < 1 for r in rows) and len({(r.doc_id, r.epoch) for r in rows}) == len(rows)
    # whole passes hold every document
    for s, (t, n) in have.items():
        passes = got[s] / t
        for e in range(int(passes)):
            assert sum(r.source == s and r.epoch == e for r in rows) == n
    # epochs are different permutations, and sources are spread over the mixture
    c = [[r.doc_id for r in sorted(rows, key=lambda r: r.slot) if r.source == "c" and r.epoch == e] for e in (0, 1)]
    assert c[0] != c[1] and abs(sum(r.slot for r in rows if r.source == "a") / sum(r.source == "a" for r in rows) - 0.5) < 0.1


def test_entropy_target(spark):
    s = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 10)], "source string, tokens long")
    alpha = find_exponent(s, 1020, 1020.0, entropy=0.8)
    w = [(t / 1020) ** alpha for t in (1000, 10, 10)]
    p = [x / sum(w) for x in w]
    assert abs(-sum(x * math.log(x) for x in p) - 0.8) < 1e-6
    assert find_exponent(s, 1020, 1020.0, entropy=2.0) == 0.0 and find_exponent(s, 1020, 1020.0, repetition=0.5) == 1.0


def test_nulls_blanks_repeats_and_empty(spark, docs_of):
    df = docs_of([None, "", " \n", "a b", "a b", "a"], ids=[0, 1, 2, 3, 3, None])
    assert sorted(str((r.doc_id, r.tokens)) for r in mix(df).collect()) == sorted(map(str, [(3, 2), (3, 2), (None, 1)]))
    assert mix(docs_of([])).collect() == [] and mix(docs_of(["", None])).collect() == []
    assert [r.tokens for r in mix(docs_of(["w " * 300_000])).collect()] == [300_000]


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_sql_gives_the_same_rows(spark, sf):
    d = f"/root/testdata/{sf}"
    c = duckdb.connect()
    c.execute(f"create view documents as select * from read_parquet('{d}/documents.parquet')")
    want = c.execute(f"select doc_id, source, tokens, epoch, block, slot from ({OP5_SQL})").fetchall()
    got = [tuple(r) for r in op5_mixing(spark, d).select("doc_id", "source", "tokens", "epoch", "block", "slot").collect()]
    assert sorted(got) == sorted(want) and len(got) > 150
