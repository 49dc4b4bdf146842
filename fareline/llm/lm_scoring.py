"""Language-model scores from a log-frequency Bloom filter.

1. Every document is tokenised once. A written table keeps runs of documents as
   indexes into the run's distinct token hashes, with their training counts.
2. Distinct words, and distinct pairs of neighbouring words, of all runs meet by hash
   range. A range's task adds up the exact training counts and builds its shard of the
   filter from all of them, whatever their count: an n-gram of quantised log-count q is
   stored as q entries (n-gram, 1) ... (n-gram, q). The filter grows with the corpus.
3. A count is read by probing 1, 2, ... until the first miss. As long as all shards
   together take at most ``filter_bytes``, they are broadcast and the workers that score
   probe them. A larger filter stays where it is: the runs' n-grams, which met their
   shard's task by hash range anyway, are probed there and the levels go back to the
   runs. The shards are the same bits either way, and so are the scores.
4. Scores interpolate pair estimates with word estimates; unseen words share the mass of
   the words seen once. The exact word totals also give the base (unigram) score.

Probes can only overestimate, by a level with probability 2**-HASHES or so.

Defined results: a null or empty text is the end token alone; a null id hashes as the
empty text and keeps its row; repeated rows are separate documents; a very long text is
one document of its run; without training documents the counts are 0; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import SPACE_SPLIT, document_words, materialize, mix64

RUN_BYTES = 2 << 20
# distinct n-grams of all runs that meet in one task
BUCKET_ENTRIES = 1 << 20
# bytes of the whole filter that are broadcast; above, it is probed by shard
FILTER_BYTES = 32 << 20
LEVEL_BASE = 1.3
HASHES, BITS_PER_ENTRY = 6, 10
PAIR_WEIGHT = 0.4
END = mix64(np.array([0xE0F], np.uint64))[0]

_A, _B, _LEVEL = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xD6E8FEB86659FD93)
_LOW = np.uint64(0xFFFFFFFF)
RUN_SCHEMA = "run long, ids array<long>, held array<boolean>, first binary, tokens binary, keys binary, counts binary, n_keys long, n_train long, n_tokens long"


def _runs(run_bytes: int):
    """Runs of documents (id, held, text) with their tokens as indexes into sorted distinct hashes."""

    def pack(run, parts):
        ids, held, lengths, hashes = [sum(p, []) if isinstance(p[0], list) else np.concatenate(p) for p in zip(*parts)]
        keys, tokens = np.unique(hashes, return_inverse=True)
        train = ~np.repeat(np.array(held, bool), lengths)
        return pa.record_batch(
            [
                pa.array([run]),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([held], pa.list_(pa.bool_())),
                pa.array([np.cumsum(np.append(0, lengths)).astype(np.int64).tobytes()], pa.binary()),
                pa.array([tokens.astype(np.uint32).tobytes()], pa.binary()),
                pa.array([keys.tobytes()], pa.binary()),
                pa.array([np.bincount(tokens[train], minlength=len(keys)).astype(np.uint32).tobytes()], pa.binary()),
                pa.array([len(keys)]),
                pa.array([int(train.sum())]),
                pa.array([len(tokens)]),
            ],
            names=["run", "ids", "held", "first", "tokens", "keys", "counts", "n_keys", "n_train", "n_tokens"],
        )

    def run(batches):
        part, n, size, parts = TaskContext.get().partitionId(), 0, 0, []
        for b in batches:
            for first, last, w in document_words(b.column(2), SPACE_SPLIT):
                lengths = np.diff(w.first) + 1
                hashes = np.full(len(w.hash) + w.n_docs, END, np.uint64)
                hashes[np.arange(len(w.hash)) + w.doc] = w.hash
                parts.append((b.column(0)[first:last].to_pylist(), b.column(1)[first:last].to_pylist(), lengths, hashes))
                size += int(w.ends[-1]) if len(w.ends) else 1
                if size >= run_bytes:
                    yield pack((part << 32) | n, parts)
                    n, size, parts = n + 1, 0, []
        if parts:
            yield pack((part << 32) | n, parts)

    return run


def _range_of(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


PART_SCHEMA = "range long, run long, keys binary, counts binary, width int"


def _by_range(keys: np.ndarray, counts: np.ndarray, ranges: int, run: int, short: bool) -> pa.RecordBatch:
    """Rows (range, run, keys, counts) of sorted keys; ``short``: the keys' low 32 bits, which tell the keys of a range apart."""
    r = _range_of(keys, ranges)
    start = np.flatnonzero(np.diff(r, prepend=-1))
    stop = np.append(start[1:], len(r))
    sent = (keys & _LOW).astype(np.uint32) if short else keys
    counts = counts.astype(np.min_scalar_type(int(counts.max(initial=0))))
    return pa.record_batch(
        [
            pa.array(r[start]),
            pa.array(np.full(len(start), run)),
            pa.array([sent[a:z].tobytes() for a, z in zip(start, stop)], pa.binary()),
            pa.array([counts[a:z].tobytes() for a, z in zip(start, stop)], pa.binary()),
            pa.array(np.full(len(start), counts.itemsize, np.int32)),
        ],
        names=["range", "run", "keys", "counts", "width"],
    )


def _column(table, name: str, kind=None) -> list:
    """A binary column's values as arrays (or buffers), without a copy."""
    out = [x.as_buffer() for chunk in [table.column(name)] for x in chunk]
    return [np.frombuffer(x, kind) for x in out] if kind else out


def _split_words(ranges: int):
    def run(batches):
        for b in batches:
            for r, k, c in zip(b.column("run").to_pylist(), _column(b, "keys", np.uint64), _column(b, "counts", np.uint32)):
                yield _by_range(k, c, ranges, r, False)

    return run


def pair_keys(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix64(a * _A + mix64(b * _B))


def _pairs(first, tokens) -> np.ndarray:
    """Places of tokens that follow another one in the same document."""
    inside = np.ones(len(tokens), bool)
    inside[first[:-1]] = False
    return np.flatnonzero(inside)


def _run_pairs(first, tokens, keys):
    """(distinct pairs as token codes, their key hashes, the order of the hashes, each place's pair)."""
    at = _pairs(first, tokens)
    code, back = np.unique((tokens[at - 1].astype(np.int64) << 32) | tokens[at], return_inverse=True)
    h = pair_keys(keys[code >> 32], keys[code & 0xFFFFFFFF])
    return at, code, h, np.argsort(h, kind="stable"), back


def _split_pairs(ranges: int):
    """Every pair of a run, with its occurrences in training documents (0 for pairs of held-out ones alone)."""

    def run(batches):
        for b in batches:
            held = b.column("held").to_pylist()
            for i, (r, first, tokens, keys) in enumerate(zip(b.column("run").to_pylist(), _column(b, "first", np.int64), _column(b, "tokens", np.uint32), _column(b, "keys", np.uint64))):
                at, code, h, order, back = _run_pairs(first, tokens, keys)
                if len(code):
                    train = ~np.repeat(np.array(held[i], bool), np.diff(first))
                    n = np.bincount(back[train[at]], minlength=len(code))
                    yield _by_range(h[order], n[order], ranges, r, True)

    return run


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised log-counts, 1 for a count of 1."""
    return 1 + np.floor(np.log(counts) / math.log(LEVEL_BASE) + 1e-9).astype(np.int64)


def count_of(level: np.ndarray) -> np.ndarray:
    """Counts that levels stand for: the middle of the integers a level holds, on the log scale; 0 for level 0."""
    low = np.ceil(LEVEL_BASE ** (level - 1.0) - 1e-9)
    high = np.maximum(low, np.ceil(LEVEL_BASE ** (level + 0.0) - 1e-9) - 1)
    return np.where(level > 0, np.sqrt(low * high), 0.0)


def _places(keys: np.ndarray, level: int, bits: int) -> list[np.ndarray]:
    h = mix64(keys + np.uint64((level * int(_LEVEL)) % (1 << 64)))
    step = mix64(h) | np.uint64(1)
    return [((((h + np.uint64(i) * step) >> np.uint64(32)) * np.uint64(bits)) >> np.uint64(32)).astype(np.int64) for i in range(HASHES)]


@dataclass
class LogBloom:
    """Packed bits; an n-gram's level is read by repeated membership probes."""

    bits: int
    packed: np.ndarray
    top: int

    @classmethod
    def build(cls, keys: np.ndarray, q: np.ndarray, bits_per_entry: int = BITS_PER_ENTRY) -> LogBloom:
        """A key of level q is stored q times."""
        bits = max(64, int(q.sum()) * bits_per_entry)
        flat, top = np.zeros(bits, bool), int(q.max(initial=0))
        for j in range(1, top + 1):
            for at in _places(keys[q >= j], j, bits):
                flat[at] = True
        return cls(bits, np.packbits(flat, bitorder="little"), top)

    def level(self, keys: np.ndarray) -> np.ndarray:
        q = np.zeros(len(keys), np.uint8)
        alive = np.arange(len(keys))
        for j in range(1, self.top + 1):
            for at in _places(keys[alive], j, self.bits):
                hit = (self.packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1
                # later places of a missed key don't matter; all are of one length here
                alive = np.where(hit, alive, -1)
            alive = alive[alive >= 0]
            if not len(alive):
                break
            q[alive] = j
        return q


TOTAL_SCHEMA = "run long, range long, totals binary, levels binary, shard binary, bits long, top int, types long, once long, norm double"


def _totals(short: bool, bits_per_entry: int, respond: bool):
    """A range: its shard of the filter (run -1), and per run totals (of words) and levels, in the run's order."""

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        rng = table.column("range")[0].as_py()
        widths = table.column("width").to_pylist()
        parts = [np.frombuffer(x.as_buffer(), np.uint32 if short else np.uint64) for x in table.column("keys")]
        counts = np.concatenate([np.frombuffer(x.as_buffer(), f"u{w}") for x, w in zip(table.column("counts"), widths)], dtype=np.int64)
        keys, at = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, at, counts)
        seen = total > 0
        full = keys.astype(np.uint64) | np.uint64(rng << 32) if short else keys
        q = levels(total[seen])
        bloom = LogBloom.build(full[seen], q, bits_per_entry)
        read = bloom.level(full)
        rows = [(-1, rng, None, None, bloom.packed.tobytes(), bloom.bits, bloom.top, int(seen.sum()), int((total == 1).sum()), float(count_of(q).sum()))]
        if respond or not short:
            end = 0
            for r, p in zip(table.column("run").to_pylist(), parts):
                mine, end = at[end : end + len(p)], end + len(p)
                rows.append((r, rng, None if short else total[mine].tobytes(), read[mine].tobytes() if respond else None, None, None, None, None, None, None))
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["run", "range", "totals", "levels", "shard", "bits", "top", "types", "once", "norm"])

    return run


@dataclass
class Model:
    """What scoring needs: a few totals, and the shards where they are broadcast."""

    n_train: int
    types: int
    word_mass: float
    word_norm: float
    rest: float
    words: list[LogBloom] | None = None
    pairs: list[LogBloom] | None = None

    def probe(self, shards: list[LogBloom], keys: np.ndarray, short: bool) -> np.ndarray:
        """Levels of sorted keys, each read from its range's shard."""
        rng = _range_of(keys, len(shards))
        full = (keys & _LOW) | (rng.astype(np.uint64) << np.uint64(32)) if short else keys
        start = np.searchsorted(rng, np.arange(len(shards) + 1))
        return np.concatenate([np.zeros(0, np.uint8), *(s.level(full[a:z]) for s, a, z in zip(shards, start[:-1], start[1:]) if z > a)])


def _in_range_order(table: pa.Table, kind: str, column: str, dtype) -> np.ndarray:
    """A run's answers, joined in the order of their ranges."""
    rows = [(r, x) for k, r, x in zip(table.column("kind").to_pylist(), table.column("range").to_pylist(), table.column(column)) if k == kind and x.is_valid]
    return np.concatenate([np.zeros(0, dtype), *(np.frombuffer(x.as_buffer(), dtype) for _, x in sorted(rows, key=lambda y: y[0]))])


SCORE_SCHEMA = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _scores(model_b):
    """Base and model scores of a run's documents."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        model, out = model_b.value, []
        base_norm = math.log10(model.n_train + 0.5 * (model.types + 1))
        left = left.combine_chunks()
        for i in range(left.num_rows):
            first, tokens, keys = (np.frombuffer(left.column(c)[i].as_buffer(), t) for c, t in (("first", np.int64), ("tokens", np.uint32), ("keys", np.uint64)))
            n = np.diff(first)
            total = _in_range_order(right, "w", "totals", np.int64)
            base = np.add.reduceat(np.log10(total + 0.5)[tokens], first[:-1]) - n * base_norm
            known = np.add.reduceat((total > 0).astype(np.int64)[tokens], first[:-1])
            level = model.probe(model.words, keys, False) if model.words else _in_range_order(right, "w", "levels", np.uint8)
            c = count_of(level.astype(np.int64))
            p = np.where(c > 0, model.word_mass * c / model.word_norm, model.rest)
            prob = p[tokens]
            at, code, h, order, back = _run_pairs(first, tokens, keys)
            if len(code):
                sorted_levels = model.probe(model.pairs, h[order], True) if model.words else _in_range_order(right, "p", "levels", np.uint8)
                joint = np.empty(len(code))
                joint[order] = count_of(sorted_levels.astype(np.int64))
                a, z = code >> 32, code & 0xFFFFFFFF
                # a first word that was never seen leaves the word estimate alone
                follow = np.where(c[a] > 0, np.minimum(1.0, joint / np.where(c[a] > 0, c[a], 1.0)), 0.0)
                mixed = np.where(c[a] > 0, PAIR_WEIGHT * follow + (1 - PAIR_WEIGHT) * p[z], p[z])
                prob[at] = mixed[back]
            held = left.column("held")[i].as_py()
            ids = left.column("ids")[i].as_py()
            out.append(pa.table({
                "id": pa.array(ids, pa.int64()), "held_out": pa.array(held, pa.bool_()), "n_tokens": n, "n_known": known,
                "base_score": base, "score": np.add.reduceat(np.log10(prob), first[:-1]),
            }))
        return pa.concat_tables(out) if out else pa.table({"id": pa.array([], pa.int64()), "held_out": pa.array([], pa.bool_()), "n_tokens": pa.array([], pa.int64()), "n_known": pa.array([], pa.int64()), "base_score": pa.array([], pa.float64()), "score": pa.array([], pa.float64())})

    return run


def _shards(totals: DataFrame, ranges: int) -> list[LogBloom]:
    """All shards of a filter that is within the broadcast bound; ranges without n-grams are empty."""
    rows = {r.range: r for r in totals.where("run = -1").select("range", "shard", "bits", "top").collect()}
    none = LogBloom(64, np.zeros(8, np.uint8), 0)
    return [LogBloom(rows[k].bits, np.frombuffer(rows[k].shard, np.uint8), rows[k].top) if k in rows else none for k in range(ranges)]


def lm_scores(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    held_col=None,
    run_bytes: int = RUN_BYTES,
    filter_bytes: int = FILTER_BYTES,
    bits_per_entry: int = BITS_PER_ENTRY,
    bucket_entries: int = BUCKET_ENTRIES,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score, filter_bytes) per row of ``docs``.

    ``held_col``: a boolean column that keeps documents from training (null: trains).
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(held_col if held_col is not None else F.lit(False), F.lit(False)).alias("held"),
        F.col(text_col).alias("text"),
    )
    runs = materialize(rows.mapInArrow(_runs(run_bytes), RUN_SCHEMA), "runs")
    entries, n_train, n_tokens = runs.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_keys", "n_train", "n_tokens")]).first()
    word_ranges, pair_ranges = (max(1, -(-n // bucket_entries)) for n in (entries, n_tokens))
    words = runs.select("run", "keys", "counts").mapInArrow(_split_words(word_ranges), PART_SCHEMA)
    pairs = runs.select("run", "held", "first", "tokens", "keys").mapInArrow(_split_pairs(pair_ranges), PART_SCHEMA)
    words = materialize(words.groupBy("range").applyInArrow(_totals(False, bits_per_entry, True), TOTAL_SCHEMA), "words")
    pairs = materialize(pairs.groupBy("range").applyInArrow(_totals(True, bits_per_entry, True), TOTAL_SCHEMA), "pairs")

    def shards(df):
        return df.where("run = -1").agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("types", "once", "norm", "bits")]).first()

    types, once, norm, word_bits = shards(words)
    size = (word_bits + shards(pairs)[3]) // 8
    unseen = max(once, 1)
    model = Model(n_train, types, n_train / (n_train + once) if n_train else 0.0, float(norm) or 1.0, unseen / (n_train + unseen) / (once + 1))
    answers = words.where("run >= 0").select("run", "range", F.lit("w").alias("kind"), "totals", "levels")
    if size <= filter_bytes:
        model.words, model.pairs = _shards(words, word_ranges), _shards(pairs, pair_ranges)
        answers = answers.withColumn("levels", F.lit(None).cast("binary"))
    else:
        answers = answers.union(pairs.where("run >= 0").select("run", "range", F.lit("p"), "totals", "levels"))
    left = runs.select("run", "ids", "held", "first", "tokens", "keys").groupBy("run")
    scores = left.cogroup(answers.groupBy("run")).applyInArrow(_scores(spark.sparkContext.broadcast(model)), SCORE_SCHEMA)
    return scores.select(
        F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score", F.lit(size).cast("long").alias("filter_bytes")
    )


def fold(id_col: str = "doc_id"):
    """crc32 of an id as text, modulo 5."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), F.lit(5))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the model of the documents outside fold 1."""
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"), held_col=fold() == 1)
