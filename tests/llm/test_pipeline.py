import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from test_decontaminate import brute as brute_windows
from test_jaccard_join import brute as brute_components
from test_pii import brute as brute_spans

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows of the input and of every stage's output."""
    top = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for name, stage in P.STAGES:
        stage(spark, docs, SF).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
        out.append(docs.collect())
    return out


def test_quality_rejects_junk_and_keeps_clean(spark, stages):
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    kept = {r.doc_id for r in stages[1]}
    assert set(stages[1]) <= set(stages[0])
    clean = [d.doc_id for d in stages[0] if d.doc_id in labels and labels[d.doc_id].quality == 1 and not labels[d.doc_id].toxic]
    junk = [d.doc_id for d in stages[0] if d.doc_id in labels and labels[d.doc_id].quality == 0]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean) and sum(i in kept for i in junk) <= 0.2 * len(junk)


def test_one_document_of_each_component_stays(stages):
    groups = brute_components([(d.doc_id, d.text) for d in stages[1]], P.SHINGLE, P.THRESHOLD)
    assert sorted(r.doc_id for r in stages[2]) == sorted({c for _, _, c in groups})
    assert set(stages[2]) <= set(stages[1])


def test_contaminated_documents_go(spark, stages):
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    want = [d for d, n, h, _ in brute_windows([(d.doc_id, d.text) for d in stages[2]], items) if not (h and 20 * h >= n)]
    assert sorted(r.doc_id for r in stages[3]) == sorted(want) and len(want) < len(stages[2])


def test_personal_data_is_replaced_and_the_rest_left(stages):
    before = {d.doc_id: d for d in stages[3]}
    assert {d.doc_id for d in stages[4]} == set(before)
    for d in stages[4]:
        assert d.n_chars == len(d.text) and not [s for s in brute_spans(d.text)]
        plain = re.escape(before[d.doc_id].text)
        kinds = re.findall(r"\[(EMAIL|IP|CARD|PHONE)\]", d.text)
        if not kinds:
            assert d.text == before[d.doc_id].text
        else:
            pattern = ".+?".join(re.escape(x) for x in re.split(r"\[(?:EMAIL|IP|CARD|PHONE)\]", d.text))
            assert re.fullmatch(pattern, before[d.doc_id].text, re.S), plain[:80]


def test_mixture_holds_every_source_to_its_limit(stages):
    words = {d.doc_id: len((d.text or "").split()) for d in stages[4]}
    source = {d.doc_id: d.source for d in stages[4]}
    have, got = {}, {}
    for i, n in words.items():
        have[source[i]] = have.get(source[i], 0) + n
    for r in stages[5]:
        got[r.source] = got.get(r.source, 0) + r.tokens
        assert r.source == source[r.doc_id]
    assert set(got) == {s for s, n in have.items() if n}
    assert all(got[s] <= 1.26 * have[s] + max(words.values()) for s in got)
    assert abs(sum(got.values()) - sum(have.values())) < 20 * max(words.values())


def test_run_and_odd_rows(spark, tmp_path):
    assert P.run(spark, SF).count() > 100
    rows = [(1, None, None, None, None), (None, "a b c d e f g", "en", "s", 13), (2, "a b c d e f g", "en", "s", 13), (2, "a b c d e f g", "en", "s", 13), (3, "", "en", None, 0), (4, "x " * 50_000, "en", "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("sid", F.lit(1)).withColumn("block", F.lit("x"))
    for k, (_, stage) in enumerate(P.STAGES):
        for empty in (True, False):
            got = stage(spark, docs.limit(0) if empty else docs, SF)
            if empty:
                assert got.collect() == []
            elif k < 4:
                assert got.columns == docs.columns
                if k == 1:
                    assert sorted((r.doc_id, r.text) for r in got.collect() if r.doc_id) == [(1, None), (2, rows[2][1]), (3, ""), (4, rows[5][1])]
            else:
                assert {r.doc_id for r in got.collect()} == {None, 2, 4}
