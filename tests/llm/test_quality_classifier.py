import random

import numpy as np
from pyspark.sql import functions as F

from fareline.llm.quality_classifier import Views, classify, co_train, document_odds, draw_sample, fit_logistic, meta_keys, op10_quality_classifier


def corpus(spark, n=600, seed=1):
    rnd = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        bad, toxic = rnd.random() < 0.2, rnd.random() < 0.2
        words = [f"w{rnd.randrange(400)}" for _ in range(rnd.randrange(20, 80))]
        text = " ".join(words)
        if bad:
            text = text.upper().replace(" ", "!! ")
        if toxic:
            text = text.replace(" ", " vile ", 1)
        docs.append((i, text, rnd.choice(["en", None]), "spam" if bad and rnd.random() < 0.8 else "web", len(text)))
        if rnd.random() < 0.6:
            labels.append((i, int(not bad), int(toxic)))
    return (
        spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        {i: ("!!" in t, " vile " in t) for i, t, *_ in docs},
    )


def test_both_targets_are_learnt_and_clean_documents_stay(spark):
    docs, labels, truth = corpus(spark)
    got = classify(docs.withColumn("words", F.lit(1)), labels.withColumn("text", F.lit("x"))).collect()
    assert len(got) == len(truth)
    wrong = sum(r.accepted != (not any(truth[r.doc_id])) for r in got)
    assert wrong <= 0.02 * len(got)


def test_scores_match_a_plain_restatement(spark):
    docs, labels, _ = corpus(spark, 300, 2)
    views = co_train(draw_sample(docs, labels))
    for r in docs.limit(40).collect():
        buf = np.frombuffer(r.text.encode(), np.uint8)
        one = document_odds(buf, np.array([0, len(buf)]), [meta_keys(r.lang, r.source, r.n_chars)], views)
        got = classify(docs.where(F.col("doc_id") == r.doc_id), labels, views=views).collect()[0] if r.doc_id % 20 == 0 else None
        if got:
            assert abs(got.p_toxic - 1 / (1 + np.exp(-one["toxic"][0]))) < 1e-6


def test_held_out_accuracy_on_the_given_table(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.col("doc_id") % 4 == 0
    got = classify(docs.join(labels, "doc_id").where(held).select(docs.columns), labels, views=co_train(draw_sample(docs, labels.where(~held))))
    rows = got.join(labels, "doc_id").collect()
    bad = [r for r in rows if r.quality == 0 or r.toxic == 1]
    good = [r for r in rows if r.quality == 1 and r.toxic == 0]
    assert sum(not r.accepted for r in bad) > 0.93 * len(bad)
    assert sum(r.accepted for r in good) > 0.99 * len(good)


def test_odd_rows(spark, docs_of):
    _, labels, _ = corpus(spark, 50)
    df = docs_of([None, "", "!" * 50_000, "a " * 100_000, "x", "x"], ids=[0, None, 2, 3, 4, 4])
    assert classify(df, labels).count() == 6
    assert classify(docs_of([]), labels).collect() == []
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.accepted, r.p_quality) for r in classify(docs_of(["a", None]), none).collect()] == [(True, None)] * 2
    one = spark.createDataFrame([(0, 1, None), (None, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    assert [r.accepted for r in classify(docs_of(["a", "b"]).drop("lang", "source"), one).collect()] == [True, True]


def test_samples_keep_to_their_bounds(spark):
    docs, labels, _ = corpus(spark)
    sample = draw_sample(docs, labels, labelled=100, pool=50)
    known = [r for r in sample if r.bad is not None]
    assert 60 < len(known) < 140 and 20 < len(sample) - len(known) < 90
    assert isinstance(co_train([]), Views)


def test_logistic_fit_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 3)).astype(np.float32)
    y = (x[:, 0] - 0.5 * x[:, 1] > 0.3).astype(np.float32)
    w = fit_logistic(x, y, np.ones(400, np.float32))
    assert ((x @ w[:-1] + w[-1] > 0) == (y > 0)).mean() > 0.97


def test_query_scores_every_document(spark):
    assert op10_quality_classifier(spark, "/root/testdata/sf0.001").count() == 200


def test_words_of_one_label_alone_are_chosen_at_any_sample_size():
    from fareline.llm.quality_classifier import WORDS_PER_TARGET, choose_words

    rng = np.random.default_rng(3)
    y = (rng.random(8000) < 0.1).astype(int)
    # many words a little commoner under one label, and word 1 in a third of that label's rows alone
    p = np.where(y[:, None] == 1, 0.08, 0.04)
    docs = [np.append(np.array([1] if label and rng.random() < 0.33 else [], np.uint32), (np.flatnonzero(rng.random(1500) < q) + 10).astype(np.uint32)) for label, q in zip(y, p)]
    chosen = choose_words(docs, y)
    assert len(chosen) == WORDS_PER_TARGET and 1 in chosen


def test_an_id_that_many_rows_repeat_is_one_row_of_the_sample(spark):
    docs, labels, _ = corpus(spark, 60, 3)
    hot = docs.unionByName(docs.where("doc_id = 5").crossJoin(spark.range(500)).drop("id")).unionByName(docs.where("doc_id = 5").withColumn("text", F.lit("another text of this id")))
    rows = draw_sample(hot, labels)
    assert len(rows) == 60
