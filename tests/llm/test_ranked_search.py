import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareline.llm.ranked_search import Best, Graph, build_index, op11_ranked_search, search, share


def terms_of(text):
    return Counter(re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))


def brute(docs, items, k=20):
    found = [(i, terms_of(t)) for i, t in docs]
    n_docs, n_terms = sum(1 for _, c in found if c), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c in found:
            score = 0
            for t, times in terms_of(text).items():
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    m = 100 - 25 + (25 * sum(c.values()) * n_docs) // n_terms
                    score += times * w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, r, i, -s) for r, (s, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=str)


def some(rnd, n, words):
    return [rnd.choice([" ", ", ", "\n"]).join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 12, 60]))) for _ in range(n)]


@pytest.mark.parametrize("slice_terms,k", [(50_000, 20), (40, 3)])
def test_against_brute_force(spark, docs_of, slice_terms, k):
    rnd = random.Random(k)
    words = ["The", "of", "é1", "a", *(f"w{int(rnd.paretovariate(0.7))}" for _ in range(300))]
    texts = [None, "", "...", *some(rnd, 150, words)]
    texts += [texts[5 + rnd.randrange(40)] for _ in range(60)]
    ids = [None if i == 40 else 7 if i in (50, 51) else i for i in range(len(texts))]
    asked = [None, "", "?!", *some(rnd, 25, words), texts[9], texts[9], "never seen", "the the of THE"]
    items = [(None if q == 5 else q % 20, t) for q, t in enumerate(asked)]
    table = spark.createDataFrame(items, "item_id long, text string").withColumn("row", F.lit(0)).withColumn("score", F.lit("x"))
    docs = docs_of(texts, ids=ids).withColumn("row", F.lit(1)).withColumn("terms", F.lit(2))
    index = build_index(docs, block_bytes=500).repartition(5)
    assert rows(search(index, table, k=k, slice_terms=slice_terms)) == brute(list(zip(ids, texts)), items, k)


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    assert rows(op11_ranked_search(spark, sf)) == brute(docs, items)


def test_empty_tables_and_long_texts(spark, docs_of):
    asked = [("q", "w7 common"), ("r", " ".join(f"w{i}" for i in range(30_000)))]
    items = spark.createDataFrame(asked, "item_id string, text string")
    assert search(build_index(docs_of([])), items).collect() == []
    texts = ["common", " ".join(f"w{i}" for i in range(60_000)), "w7 w7", None]
    index = build_index(docs_of(texts))
    assert search(index, items.limit(0)).collect() == []
    assert rows(search(index, items)) == brute(list(enumerate(texts)), asked)


def expand(node, nodes, n):
    return [node] if node < n else expand(nodes[node - n][0], nodes, n) + expand(nodes[node - n][1], nodes, n)


def test_sharing_keeps_every_list_and_saves_additions():
    rnd = random.Random(3)
    pool = [[rnd.randrange(80) for _ in range(rnd.randrange(2, 9))] for _ in range(12)]
    lists = [sum(rnd.sample(pool, 3), []) for _ in range(40)] + [[], [5], [5, 5, 5]]
    nodes, out = share(lists, 80)
    assert [sorted(y for x in one for y in expand(x, nodes, 80)) for one in out] == [sorted(one) for one in lists]
    uses = Counter(x for one in out for x in one) + Counter(x for p in nodes for x in p)
    assert all(uses[80 + i] for i in range(len(nodes)))
    g = Graph(range(len(lists)), [(np.unique(np.array(x, np.uint64), return_counts=True)) for x in lists])
    assert g.additions < 0.6 * g.plain_additions
    acc = np.zeros((g.n_nodes, 4), np.int64)
    acc[: len(g.vocab)] = np.random.default_rng(1).integers(0, 99, (len(g.vocab), 4))
    value = {int(t): acc[i].copy() for i, t in enumerate(g.vocab)}
    assert g.totals(acc).tolist() == [sum((value[t] for t in one), np.zeros(4, np.int64)).tolist() for one in lists]


def test_best_keeps_ties_by_id():
    best = Best(2, 2)
    for ids in ([9, 3, 5], [1, 8, 0]):
        best.add(np.array([[4, 4, 4], [0, 1, 2]]), np.array(ids), np.array([0, 0, ids[2] == 0], np.int64))
        best.shrink()
    assert best.shrink().T.tolist() == [[0, -4, 0, 1], [0, -4, 0, 3], [1, -2, 0, 5], [1, -2, 1, 0]]
