"""Token counts through a digest cache.

Every document's normalised content is digested; the (content digest, tokenizer
version digest) pair is joined to stored counts. Only distinct missing contents
are encoded, once each, and their counts are appended to the cache table.

Normalising collapses runs of ASCII white space to one space, which the tokenizer
itself would drop (checked), so equal digests have equal counts. Inside a task, white-space
separated pieces are memoised: the tokenizer never merges across white space, so
a text's count is the sum over its pieces.

Defined results: a null text counts as empty (0 bytes, 0 tokens); null and repeated
ids keep one result row per input row; a very long text is encoded piece by piece; an
empty table gives an empty result; other
columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import materialize, new_folder

CACHE_SCHEMA = "content_digest binary, tokenizer_digest binary, n_tokens bigint"
# pieces kept in a worker's memo before it is emptied (about 100 bytes each)
MEMO_PIECES = 1 << 19


def tokenizer_digest(path: str) -> bytes:
    """Version of a tokenizer: its file and the library that reads it."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).digest()


# an ASCII piece that is one run of letters and one of marks: the tokenizer lower-cases
# it and gives each run to its model as it is (no apostrophe, as in "'s", and no digit)
_PLAIN = re.compile(rb"([A-Za-z]*)([!-&(-/:-@\[-`{-~]*)")


@functools.lru_cache(maxsize=4)
def _counter(path: str):
    """A function from texts to token counts; one tokenizer and memo per worker process."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    plain = _model_takes_plain_runs(tok)
    memo: dict[bytes, int] = {}
    runs: dict[bytes, int] = {b"": 0}

    def run_count(run: bytes) -> int:
        n = runs.get(run)
        if n is None:
            n = runs[run] = len(tok.model.tokenize(run.decode()))
        return n

    def learn(new: list[bytes]) -> None:
        whole = []
        for piece in new:
            m = _PLAIN.fullmatch(piece) if plain else None
            if m:
                memo[piece] = run_count(m[1].lower()) + run_count(m[2])
            else:
                whole.append(piece)
        if whole:
            found = tok.encode_batch_fast([p.decode() for p in whole], add_special_tokens=False)
            memo.update(zip(whole, (len(x.ids) for x in found)))

    def count(text: str) -> int:
        total = 0
        pieces = text.encode().split()
        for i in range(0, len(pieces), MEMO_PIECES // 4):
            part = pieces[i : i + MEMO_PIECES // 4]
            new = list(set(part).difference(memo))
            if len(memo) + len(new) > MEMO_PIECES:
                memo.clear()
                new = list(set(part))
            if len(runs) > MEMO_PIECES:
                runs.clear()
                runs[b""] = 0
            if new:
                learn(new)
            total += sum(map(memo.__getitem__, part))
        return total

    return count


def _model_takes_plain_runs(tok) -> bool:
    """Whether this tokenizer cuts plain ASCII pieces into lower-cased runs of letters and marks."""
    samples = ["Word", "word.", "stone,", "(", "ab!!", "Xyz***", "a<|b", "q_", "Zebra|"]
    return all(
        [t for r in _PLAIN.fullmatch(s.encode()).groups() if r for t in (x.id for x in tok.model.tokenize(r.lower().decode()))]
        == tok.encode(s, add_special_tokens=False).ids
        for s in samples
        if _PLAIN.fullmatch(s.encode())
    )


def _encode(path: str):
    def run(batches):
        for b in batches:
            count = _counter(path)
            n = [count(t) for t in b.column("text").to_pylist()]
            yield pa.record_batch([b.column("content_digest"), pa.array(n, pa.int64())], ["content_digest", "n_tokens"])

    return run


def drops_white_space(path: str) -> bool:
    """Whether a tokenizer file gives a text the tokens of its white-space separated pieces, one after the other."""
    from tokenizers import Tokenizer

    try:
        tok = Tokenizer.from_file(path)
    except Exception:  # another library's file; the loader has no exception type of its own
        return False
    tok.no_truncation()
    tok.no_padding()

    def ids(text: str) -> list[int]:
        return tok.encode(text, add_special_tokens=False).ids

    samples = ["a b", " Word  word", "x\ny", "it's\t\t3.14 km", "end. \n", "d\x0be\x0cf\rg"]
    return all(ids(s) == [i for p in s.split() for i in ids(p)] for s in samples)


def content_digest(text) -> F.Column:
    """Digest of the normalised content of a text column."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+", " "), 256))


def read_cache(spark: SparkSession, path: str, version) -> DataFrame:
    """Stored counts of one tokenizer version; a cache that was never written to is empty.

    Two writers at once may store a digest twice, with the same count.
    """
    rows = spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer_digest") == version)
    return rows.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens) per row of ``docs``; misses are encoded and appended to ``cache_path``.

    Content is normalised and cut at white space, so a tokenizer that keeps white space
    (a byte-level or a sentencepiece one) raises.
    """
    if not drops_white_space(tokenizer_path):
        raise ValueError(f"{tokenizer_path}: this tokenizer keeps white space, or isn't a tokenizers file; counts by pieces would be wrong")
    spark = docs.sparkSession
    version = F.lit(tokenizer_digest(tokenizer_path))
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        content_digest(F.col(text_col)).alias("content_digest"),
    )
    keys = materialize(texts.select("id", F.octet_length("text").cast("long").alias("n_bytes"), "content_digest"), "token-keys")
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    # one row stands for each missing content; texts are met by id, so copies of one text don't pile up
    misses = (
        keys.join(read_cache(spark, cache_path, version), "content_digest", "left_anti")
        .groupBy("content_digest")
        .agg(F.min("id").alias("rep"))
        .select(F.col("content_digest").alias("digest"), "rep")
    )
    chosen = texts.join(
        misses.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("rep")) & (F.col("content_digest") == F.col("digest"))
    )
    counted = chosen.select("content_digest", "text").mapInArrow(_encode(tokenizer_path), "content_digest binary, n_tokens bigint")
    (
        counted.groupBy("content_digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
        .select("content_digest", version.alias("tokenizer_digest"), "n_tokens")
        .write.mode("append")
        .parquet(cache_path)
    )
    # a written table: copies of one text, however many, can be split in the join with it
    stored = materialize(read_cache(spark, cache_path, version), "token-stored")
    return keys.join(stored, "content_digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document; the cache starts empty, so every distinct text is encoded."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = token_counts(docs, public_tokenizers.path(TOKENIZER), new_folder(spark, "token-cache"))
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))
