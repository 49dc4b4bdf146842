import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from fareline.llm.decontaminate import decontaminate, is_contaminated, op3_decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s or "")


def brute(docs, items, window=13):
    wins = []
    for i, t in items:
        w = WORD.findall(lower(t))
        if w and i is not None:
            n = min(window, len(w))
            wins += [(str(i), tuple(w[k : k + n])) for k in range(len(w) - n + 1)]
    table = {}
    for i, w in wins:
        table.setdefault(w, set()).add(i)
    sizes = {len(w) for w in table}
    out = []
    for d, t in docs:
        words = WORD.findall(lower(t))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(words) - n + 1):
                got = table.get(tuple(words[k : k + n]))
                if got:
                    hit.update(range(k, k + n))
                    found |= got
        out.append((d, len(words), len(hit), sorted(found)))
    return out


def rows(df, id_col="doc_id"):
    return sorted(((r[id_col], r.n_words, r.n_hit, list(r["items"])) for r in df.collect()), key=str)


@pytest.mark.parametrize("slice_words,block_bytes", [(200_000, 2 << 20), (40, 300)])
def test_against_brute_force(spark, docs_of, slice_words, block_bytes):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(30)] + ["é", "ÉCOLE", "Ab1"]
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.choice([0, 1, 3, 13, 14, 40])))) for i in range(12)]
    items += [(12, items[5][1]), (3, items[6][1]), (None, "w1 w2"), (13, None), (14, "...")]
    texts = [None, "", "..."]
    for _ in range(80):
        t = rnd.choices(vocab, k=rnd.randrange(60))
        for _ in range(rnd.randrange(3)):
            w = (rnd.choice(items)[1] or "").split()
            at = rnd.randrange(len(t) + 1)
            t[at:at] = w[rnd.randrange(3) :]
        texts.append(rnd.choice([" ", "-", "\n"]).join(t).upper())
    docs = docs_of(texts).withColumn("item_id", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(5))
    got = rows(decontaminate(docs, bench, slice_words=slice_words, block_bytes=block_bytes))
    assert got == sorted(brute(list(enumerate(texts)), items), key=str)
    assert any(r[2] for r in got)


def test_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    want = {d: (n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0 and 20 * h >= n) for d, n, h, i in brute(docs, items)}
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in op3_decontaminate(spark, sf).collect()}
    assert got == want and any(v[4] for v in want.values())


def test_proximity_finds_reordered_terms(spark, docs_of):
    bench = spark.createDataFrame([(1, " ".join(f"x{i}" for i in range(13)))], "item_id long, text string")
    far = " ".join(["x0", *["y"] * 50, "x1", *["y"] * 50, "x2"])
    common = " ".join(f"x{i}" for i in range(3, 13)) + " "
    r = {x.doc_id: x for x in decontaminate(docs_of(["x2 y x0 y x1", far, "x0", common * 9]), bench).collect()}
    assert [list(r[i].near_items) for i in range(4)] == [["1"], [], [], []]
    assert all(x.n_hit == 0 for x in r.values())


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert rows(decontaminate(docs_of(["a b", None]), none)) == [(0, 2, 0, []), (1, 0, 0, [])]
    some = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert decontaminate(docs_of([]), some).where(is_contaminated()).collect() == []


def test_long_text_and_repeated_rows(spark, docs_of):
    bench = spark.createDataFrame([(7, " ".join(f"q{i}" for i in range(20)))], "item_id long, text string")
    long = "z " * 200_000 + " ".join(f"q{i}" for i in range(20))
    got = rows(decontaminate(docs_of([long, long, "q1 q2"], ids=[1, 1, None]), bench))
    assert got == [(1, 200_020, 20, ["7"]), (1, 200_020, 20, ["7"]), (None, 2, 0, [])]
