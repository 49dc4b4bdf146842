"""Shared helpers of the corpus operators: intermediate tables, Arrow text buffers, word hashing.

Words are hashed with a multilinear hash over UTF-8 bytes (one pseudo-random 64-bit
factor per byte position, summed modulo 2**64, then mixed). Two different words
collide with probability of about 2**-57, so hashes stand for words throughout.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from fareline.session import shared_dir

CHUNK_BYTES = 2 << 20
# a text is scanned and hashed by so many bytes at a time
PIECE_BYTES = 1 << 20
_FACTORS = np.zeros(0, np.uint64)


def new_folder(spark: SparkSession, tag: str) -> str:
    """A folder of its own below the shared checkpoint folder."""
    return shared_dir(spark, f"llm-{tag}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage, survives lost executors)."""
    path = new_folder(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, per_task: int = 200_000) -> DataFrame:
    """``df`` of about ``rows`` rows in tasks of at most ``per_task`` of them (but no fewer tasks than cores).

    Merges neighbouring partitions without a shuffle, so what was dealt together stays
    together; small intermediate tables then don't cost one task and file per shuffle partition.
    """
    return df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task)))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser over an array of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def factors(n: int) -> np.ndarray:
    """The first ``n`` pseudo-random factors (grown on demand; a word may be very long)."""
    global _FACTORS
    if len(_FACTORS) < n:
        size = max(256, 1 << int(n - 1).bit_length())
        _FACTORS = mix64((np.arange(size, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    return _FACTORS


def byte_table(members) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


# bytes that belong to a word; every byte of a multi-byte UTF-8 character does
SPACE_SPLIT = ~byte_table([0x20, *range(0x09, 0x0E)])
ALNUM_WORD = byte_table([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null counts as empty. The bytes aren't copied."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    buf = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return buf[offs[0] : offs[-1]], offs - offs[0]


def chunks(offs: np.ndarray, target: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Document ranges of about ``target`` bytes (one document at least)."""
    first, n = 0, len(offs) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offs, offs[first] + target, side="right")) - 1)
        yield first, min(last, n)
        first = last


def word_bounds(buf: np.ndarray, offs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of the words of a run of documents, found piece by piece."""
    n, starts, ends = len(buf), [], []
    for p in range(0, n, PIECE_BYTES):
        q = min(n, p + PIECE_BYTES)
        # the piece with a byte before and after it; a document's edge parts two words
        inside = np.zeros(q - p + 2, bool)
        inside[1:-1] = table[buf[p:q]]
        inside[0], inside[-1] = p > 0 and table[buf[p - 1]], q < n and table[buf[q]]
        edge = np.zeros(q - p + 1, bool)
        a, z = np.searchsorted(offs, [p, q + 1])
        edge[offs[a:z] - p] = True
        body = inside[1:-1]
        starts.append(np.flatnonzero(body & (edge[:-1] | ~inside[:-2])) + p)
        ends.append(np.flatnonzero(body & (edge[1:] | ~inside[2:])) + p + 1)
    return (np.concatenate(starts), np.concatenate(ends)) if n else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _long_word_hash(word: np.ndarray) -> np.uint64:
    """The hash of one word that is longer than a piece, without a factor table of its length."""
    total = np.uint64(0)
    for p in range(0, len(word), PIECE_BYTES):
        part = LOWER[word[p : p + PIECE_BYTES]].astype(np.uint64) + np.uint64(1)
        total += (mix64((np.arange(p, p + len(part), dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)) * part).sum(dtype=np.uint64)
    return mix64(np.array([total]))[0]


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z as a-z, by runs of words of about a piece's bytes."""
    out, a, n = np.zeros(len(starts), np.uint64), 0, len(starts)
    with np.errstate(over="ignore"):
        while a < n:
            if ends[a] - starts[a] > PIECE_BYTES:
                out[a] = _long_word_hash(buf[starts[a] : ends[a]])
                a += 1
                continue
            z = max(a + 1, int(np.searchsorted(ends, starts[a] + PIECE_BYTES, side="right")))
            s, size = starts[a:z], ends[a:z] - starts[a:z]
            first = np.cumsum(size) - size
            within = np.arange(int(size.sum())) - np.repeat(first, size)
            value = factors(int(size.max()))[within]
            value *= LOWER[buf[within + np.repeat(s, size)]].astype(np.uint64) + np.uint64(1)
            out[a:z] = mix64(np.add.reduceat(value, first))
            a = z
    return out


class Words:
    """Words of a run of documents: ``starts``/``ends`` in the bytes, ``doc`` index, 64-bit ``hash``.

    A very long text is worked through in pieces: beside the words themselves (some 32
    bytes each) the memory doesn't grow with it.
    """

    __slots__ = ("starts", "ends", "doc", "hash", "first", "n_docs")

    def __init__(self, buf: np.ndarray, offs: np.ndarray, table: np.ndarray):
        """``buf`` holds the documents' bytes, ``offs`` their bounds, starting at 0."""
        self.n_docs = len(offs) - 1
        self.starts, self.ends = word_bounds(buf, offs, table)
        self.first = np.searchsorted(self.starts, offs).astype(np.int64)
        self.doc = np.repeat(np.arange(self.n_docs), np.diff(self.first))
        self.hash = word_hashes(buf, self.starts, self.ends)


def document_words(column: pa.Array, table: np.ndarray, target: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """(first, last, words) for runs of documents of a string column."""
    buf, offs = text_buffer(column)
    for first, last in chunks(offs, target):
        yield first, last, Words(buf[offs[first] : offs[last]], offs[first : last + 1] - offs[first], table)
