import random
import re

import pytest
from pyspark.sql import functions as F

from fareline.llm.components import connected_components
from fareline.llm.jaccard_join import band, jaccard_components, op8_jaccard_join


def sets_of(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if 0 < len(w) < size:
        return {tuple(w)}
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute(docs, size, t):
    sets = [(i, sets_of(x, size)) for i, x in docs]
    parent = list(range(len(sets)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x and y and 100 * min(len(x), len(y)) >= t * max(len(x), len(y)) and 100 * len(x & y) >= t * len(x | y):
                parent[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            low[find(k)] = min(i, low.get(find(k), i))
    return sorted(((i, len(s), i if not s else low.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


def edited(rnd, words, share):
    out = list(words)
    for _ in range(max(1, int(len(out) * share))):
        out[rnd.randrange(len(out))] = f"e{rnd.randrange(10**6)}"
    return out


def corpus(rnd, groups=25):
    passage = [f"p{i}" for i in range(40)]
    out = [None, "", " \n", "One", "one", "one two", "One  TWO", "a b c", "a b c", "c b a"]
    for g in range(groups):
        base = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice([5, 20, 60, 200, 400]))]
        if g % 3 == 0:
            base[3:3] = passage
        for _ in range(rnd.choice([1, 2, 6, 20])):
            out.append(rnd.choice([" ", "\n"]).join(edited(rnd, base, rnd.choice([0.003, 0.01, 0.02, 0.04]))))
    rnd.shuffle(out)
    return out


def rows(df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("size,t,tile_rows,block_sets", [(3, 90, 2048, 2048), (3, 90, 3, 4), (5, 80, 2, 3)])
def test_against_brute_force(spark, docs_of, size, t, tile_rows, block_sets):
    texts = corpus(random.Random(size + tile_rows))
    docs = docs_of(texts).withColumn("sid", F.lit("x")).withColumn("band", F.lit(1))
    got = rows(jaccard_components(docs, size=size, threshold=t, tile_rows=tile_rows, block_sets=block_sets))
    want = brute(list(enumerate(texts)), size, t)
    assert got == want
    assert len({c for _, _, c in want}) < len(want) - 20


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows(op8_jaccard_join(spark, sf)) == brute(docs, 3, 90)


def test_repeated_and_null_ids(spark, docs_of):
    texts = ["a b c d", "a b c d", "x y z", "a b c d", "x y z q", None]
    ids = [4, 4, None, 9, None, None]
    assert rows(jaccard_components(docs_of(texts, ids=ids), size=3, threshold=90)) == brute(list(zip(ids, texts)), 3, 90)


def test_long_text_and_empty_table(spark, docs_of):
    long = " ".join(f"w{i}" for i in range(60_000))
    got = rows(jaccard_components(docs_of([long, long + " end", "w1"]), size=3, threshold=90))
    assert got == [(0, 59_998, 0), (1, 59_999, 0), (2, 1, 2)]
    assert rows(jaccard_components(docs_of([]))) == []


def test_linked_sizes_lie_in_adjacent_bands():
    for t in (50, 80, 90, 99):
        for b in range(1, 3000):
            assert band(b, t) - band(-(-t * b // 100), t) in (0, 1)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (3, 2)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
