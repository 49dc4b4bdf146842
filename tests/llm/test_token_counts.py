import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fareline.llm.common import new_folder
from fareline.llm.token_counts import TOKEN_LIMIT, TOKENIZER, _counter, drops_white_space, op7_token_counts, read_cache, token_counts, tokenizer_digest
from pyspark.sql import functions as F

PATH = public_tokenizers.path(TOKENIZER)
TOK = Tokenizer.from_file(PATH)

HARD = ["", " ", "It's  we'll T̈ x", "a<|endoftext|>b <|startoftext|>", "ÄÖ ß x\x85y\x1cz", "é ́x", "3.14 a1b2 __x__", "İI ΣΑΣ", "😀😀 你好"]


def expected(text):
    return len(TOK.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("aT '.s̈\n<|endoftext|>")), max_size=60))
def test_memoised_pieces_count_like_the_whole_text(text):
    assert _counter(PATH)(text) == expected(text)


def test_hard_texts():
    for t in HARD:
        assert _counter(PATH)(t) == expected(t), t


def test_counts_nulls_copies_and_repeated_ids(spark, docs_of):
    texts = [None, "", *HARD, "same text here", "same  text\nhere", "long " * 30000]
    docs = docs_of(texts).union(docs_of(["same text here", "other"], ids=[3, None])).withColumn("n_tokens", F.lit(1))
    path = new_folder(spark, "t")
    got = sorted(token_counts(docs, PATH, path).collect(), key=str)
    want = [(i, len((t or "").encode()), expected(t)) for i, t in [*enumerate(texts), (3, "same text here"), (None, "other")]]
    assert got == sorted(want, key=str) or sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_cache_is_hit_and_appended_to(spark, docs_of):
    path = new_folder(spark, "t")
    token_counts(docs_of(["a b", "c"]), PATH, path).collect()
    version = F.lit(tokenizer_digest(PATH))
    assert read_cache(spark, path, version).count() == 2
    # a stored count is taken as it is: change it, and the result follows
    digests = read_cache(spark, path, version)
    changed = new_folder(spark, "t")
    digests.select("content_digest", version.alias("tokenizer_digest"), F.lit(77).cast("long").alias("n_tokens")).write.parquet(changed)
    got = {r.doc_id: r.n_tokens for r in token_counts(docs_of(["a  b", "new one"]), PATH, changed).collect()}
    assert got == {0: 77, 1: 2}
    assert read_cache(spark, changed, version).count() == 3


def test_empty_table(spark, docs_of):
    assert token_counts(docs_of([]), PATH, new_folder(spark, "t")).collect() == []


def test_given_table(spark):
    """The registered query against the library, text by text."""
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in op7_token_counts(spark, sf).collect()}
    want = {i: (len((t or "").encode()), expected(t), expected(t) > TOKEN_LIMIT) for i, t in texts.items()}
    assert got == want and any(x[2] for x in want.values()) and not all(x[2] for x in want.values())


def test_tokenizers_that_keep_white_space_are_refused(spark, docs_of, tmp_path):
    import json

    import pytest

    assert drops_white_space(PATH)
    spec = json.loads(TOK.to_str())
    spec["pre_tokenizer"], spec["normalizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}, None
    kept = tmp_path / "kept.json"
    kept.write_text(json.dumps(spec))
    other = tmp_path / "other.model"
    other.write_bytes(b"no tokenizers file")
    for path in (kept, other):
        assert not drops_white_space(str(path))
        with pytest.raises(ValueError, match="white space"):
            token_counts(docs_of(["a b"]), str(path), new_folder(spark, "t"))
