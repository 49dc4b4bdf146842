"""Repeated byte strings by column-wise construction of a collection's suffix order.

Every byte of a 50-byte string that also starts in a document with a smaller id goes.

1. Documents are written as runs of whole texts, bucketed by run, so that later steps
   meet a run's answers without moving its text again.
2. Anchors. Each 50-byte window has the smallest hash of the 20-byte strings in it as
   its anchor; equal windows have equal anchors at equal offsets. Windows next to each
   other with one anchor form a segment (80 bytes at most). Anchors that stand in two
   documents or more are found by hash range; other text can't repeat.
3. Construction. The distinct segments of a range of anchors are a collection of short
   strings. Their symbols are byte pairs, so each segment gives two strings, one per
   parity. Round by round one symbol is put before every string's current suffix: the
   suffix order of the next round is the stable distribution of the Burrows-Wheeler
   transform by symbol (a stable sort of the round's symbols). In the last 25 rounds the
   common-prefix classes are updated in the same pass: two neighbours agree in t symbols
   if they have one symbol and all between their former places agreed in t - 1.
   A range has a bounded number of segments, so the order and the classes are arrays in
   memory rather than files that are read and written sequentially.
   Segments are folded first: equal ones are one string, and a string whose anchor no
   other string has needs no comparison.
4. Neighbours that agree in 25 symbols are equal windows; the smallest id of each class
   goes back to the runs, which remove what is covered and digest the rest.

An anchor in very many documents (``hot``) could fill a range: its windows are strings
of their own, dealt by their own hash, so no key holds more than its distinct windows.

Defined results: a null text counts as empty; texts under 50 bytes lose nothing; a null
id counts as larger than every other; rows with one id don't remove each other; an
empty table gives an empty result; a very long text is a run of its own; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import chunks, materialize, mix64, new_folder, text_buffer

WINDOW, GRAM = 50, 20
# windows that one anchor can serve, and so the bytes of the longest segment
REACH = WINDOW - GRAM + 1
LONGEST = REACH - 1 + WINDOW
RUN_BYTES = 2 << 20
# bytes taken at a time when anchors are searched (their arrays then stay in the cache)
STEP = 1 << 17
ANCHORS_PER_RANGE, SEGMENTS_PER_RANGE = 2_000_000, 16_000
HOT_DOCS = 50_000
MOST_BUCKETS = 8192
NO_ID = np.iinfo(np.int64).max

RUN_SCHEMA = "run long, ids binary, offsets binary, text binary"
_M = [pow(0x9E3779B1, k, 1 << 32) for k in range(17)]
_GRAM_FACTORS = mix64(np.arange(1, GRAM + 1, dtype=np.uint64)) | np.uint64(1)


def _runs(run_bytes: int):
    """Whole documents packed into runs of about ``run_bytes``."""

    def pack(run, ids, sizes, texts):
        offsets = np.cumsum(np.concatenate([[0], *sizes])).astype(np.int64)
        return pa.record_batch(
            [pa.array([run]), pa.array([np.concatenate(ids).tobytes()], pa.binary()), pa.array([offsets.tobytes()], pa.binary()), pa.array([b"".join(texts)], pa.binary())],
            names=["run", "ids", "offsets", "text"],
        )

    def run(batches):
        part, n, held, ids, sizes, texts = TaskContext.get().partitionId(), 0, 0, [], [], []
        for b in batches:
            own = b.column(0).fill_null(int(NO_ID)).to_numpy()
            buf, offs = text_buffer(b.column(1))
            for first, last in chunks(offs, run_bytes):
                ids.append(own[first:last])
                sizes.append(np.diff(offs[first : last + 1]))
                texts.append(buf[offs[first] : offs[last]].tobytes())
                held += len(texts[-1]) + 1
                if held >= run_bytes:
                    yield pack((part << 32) | n, ids, sizes, texts)
                    n, held, ids, sizes, texts = n + 1, 0, [], [], []
        if ids:
            yield pack((part << 32) | n, ids, sizes, texts)

    return run


def _window_anchors(buf: np.ndarray) -> np.ndarray:
    """For each 50-byte window of ``buf`` the place of its anchor (the leftmost smallest hash)."""
    h1 = buf.astype(np.uint32)
    h1 += np.uint32(1)
    h2 = h1[:-1] * np.uint32(_M[1]) + h1[1:]
    h4 = h2[:-2] * np.uint32(_M[2]) + h2[2:]
    h8 = h4[:-4] * np.uint32(_M[4]) + h4[4:]
    h16 = h8[:-8] * np.uint32(_M[8]) + h8[8:]
    h = h16[:-4] * np.uint32(_M[4]) + h4[16:]
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x85EBCA6B)
    h ^= h >> np.uint32(13)
    h *= np.uint32(0xC2B2AE35)
    m = (h.astype(np.uint64) << np.uint64(32)) | np.arange(len(h), dtype=np.uint64)
    for s in (1, 2, 4, 8):
        m = np.minimum(m[:-s], m[s:])
    m = np.minimum(m[: -(REACH - 16)], m[REACH - 16 :])
    return m.astype(np.uint32).astype(np.int64)


def segments(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, last window, anchor place, document) of all segments of a run's documents."""
    n = len(buf)
    out = []
    for a in range(0, n - WINDOW + 1, STEP):
        part = buf[a : a + STEP + WINDOW - 1]
        at = _window_anchors(part)
        at += a
        # windows that a document's end cuts
        lo, hi = np.searchsorted(offs, (a, a + len(at) + WINDOW))
        for end in offs[lo:hi].tolist():
            at[max(0, end - WINDOW + 1 - a) : max(0, end - a)] = -1
        new = np.flatnonzero(np.diff(at, prepend=-2))
        end = np.append(new[1:], len(at)) - 1
        keep = at[new] >= 0
        out.append((new[keep] + a, end[keep] + a, at[new][keep]))
    if not out:
        z = np.zeros(0, np.int64)
        return z, z, z, z
    first, last, at = (np.concatenate(x) for x in zip(*out))
    # pieces of one segment that a step's end cut apart
    doc = np.searchsorted(offs, first, side="right") - 1
    joined = np.append(False, (at[1:] == at[:-1]) & (first[1:] == last[:-1] + 1) & (doc[1:] == doc[:-1]))
    start = np.flatnonzero(~joined)
    return first[start], last[np.append(start[1:], len(first)) - 1] if len(start) else last, at[start], doc[start]


def anchor_keys(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """64-bit hashes of the 20-byte strings at ``at``."""
    key = np.zeros(len(at), np.uint64)
    for k in range(GRAM):
        key += (buf[at + k].astype(np.uint64) + np.uint64(1)) * _GRAM_FACTORS[k]
    return mix64(key)


def _ranges(keys: np.ndarray, ranges: int) -> np.ndarray:
    return (((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)).astype(np.int64)


def _blobs(values: np.ndarray, cut: np.ndarray) -> pa.Array:
    """``values`` as binaries, cut at the positions ``cut``."""
    data = np.ascontiguousarray(values)
    ends = np.append(cut, len(data)) * data.dtype.itemsize
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cut), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(data.tobytes())]).cast(pa.binary())


def _flat(column: pa.ChunkedArray, dtype) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column in one array, and the number of values in each row."""
    a = column.cast(pa.large_binary()).combine_chunks()
    a = a.chunk(0) if isinstance(a, pa.ChunkedArray) else a
    _, offsets, data = a.buffers()
    offs = np.frombuffer(offsets, np.int64)[a.offset : a.offset + len(a) + 1]
    raw = np.frombuffer(data, np.uint8)[offs[0] : offs[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw.view(dtype) if len(raw) else np.zeros(0, dtype), np.diff(offs) // np.dtype(dtype).itemsize


def _read_run(ids, offsets, text):
    return np.frombuffer(ids, np.int64), np.frombuffer(offsets, np.int64), np.frombuffer(text, np.uint8)


def _run_anchors(ids, offs, buf):
    """Segments of a run, its distinct anchor keys, each segment's key and the documents per key."""
    first, last, at, doc = segments(buf, offs)
    keys, key = np.unique(anchor_keys(buf, at), return_inverse=True)
    seen = np.unique(key.astype(np.int64) * len(ids) + doc) // max(len(ids), 1)
    return first, last, at, doc, keys, key, np.bincount(seen, minlength=len(keys))


def _anchor_rows(ranges: int):
    """Rows (range, run, low halves of the keys, documents per key)."""

    def run(batches):
        for b in batches:
            for r, *packed in zip(*(x.to_pylist() for x in b.columns)):
                *_, keys, _, docs = _run_anchors(*_read_run(*packed))
                if len(keys):
                    rng = _ranges(keys, ranges)
                    cut = np.flatnonzero(np.diff(rng, prepend=-1))
                    low = keys.astype(np.uint32)
                    yield pa.record_batch(
                        [pa.array(rng[cut]), pa.array(np.full(len(cut), r)), _blobs(low, cut), _blobs(np.minimum(docs, 0xFFFF).astype(np.uint16), cut)],
                        names=["range", "run", "keys", "docs"],
                    )

    return run


def _shared(hot_docs: int):
    """Per run of a range, one byte a key: 0 in one document only, 1 shared, 2 in very many."""

    def run(table: pa.Table) -> pa.Table:
        keys, size = _flat(table.column("keys"), np.uint32)
        docs, _ = _flat(table.column("docs"), np.uint16)
        distinct, back = np.unique(keys, return_inverse=True)
        total = np.bincount(back, weights=docs, minlength=len(distinct))
        state = np.where(total >= hot_docs, 2, np.where(total >= 2, 1, 0)).astype(np.uint8)
        cut = np.cumsum(size) - size
        return pa.table({"run": table.column("run"), "range": table.column("range"), "state": _blobs(state[back], cut)})

    return run


def _state(answers: pa.Table) -> np.ndarray:
    order = np.argsort(answers.column("range").to_numpy())
    return _flat(answers.column("state").take(pa.array(order)), np.uint8)[0] if len(order) else np.zeros(0, np.uint8)


def _strings(buf: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Segments as rows of bytes, padded with zeros."""
    place = first[:, None] + np.arange(LONGEST)
    rows = buf[np.minimum(place, len(buf) - 1)] if len(first) else np.zeros((0, LONGEST), np.uint8)
    rows[np.arange(LONGEST) >= (last - first + WINDOW)[:, None]] = 0
    return rows


def _distinct(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one index of each distinct string, each string's distinct number); strings differ by bytes or size."""
    if not len(rows):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    whole = np.concatenate([rows, size[:, None].astype(np.uint8)], axis=1)
    view = np.ascontiguousarray(whole).view([("", f"V{whole.shape[1]}")]).ravel()
    h = mix64(np.ascontiguousarray(np.pad(whole, ((0, 0), (0, -whole.shape[1] % 8)))).view(np.uint64) @ (mix64(np.arange(1, -(-whole.shape[1] // 8) + 1, dtype=np.uint64)) | np.uint64(1)))
    order = np.argsort(h, kind="stable")
    new = np.append(True, h[order[1:]] != h[order[:-1]])
    # strings of one hash are compared in full; a hash of two strings (never seen) falls back to the bytes
    if not (view[order[1:]] == view[order[:-1]])[~new[1:]].all():
        _, one, number = np.unique(view, return_index=True, return_inverse=True)
        return one, number
    number = np.empty(len(h), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


class RunSegments:
    """The shared segments of a run: their places, and the distinct strings in the order of their ranges."""

    def __init__(self, packed, answers: pa.Table, ranges: int):
        self.ids, self.offs, self.buf = _read_run(*packed)
        first, last, at, doc, keys, key, _ = _run_anchors(self.ids, self.offs, self.buf)
        state = _state(answers)
        own = state[key] if len(state) else np.zeros(len(key), np.uint8)
        plain, hot = np.flatnonzero(own == 1), np.flatnonzero(own == 2)
        many = last[hot] - first[hot] + 1
        alone = np.repeat(first[hot] - (np.cumsum(many) - many), many) + np.arange(many.sum())
        self.first = np.concatenate([first[plain], alone])
        self.last = np.concatenate([last[plain], alone])
        self.doc = np.concatenate([doc[plain], np.repeat(doc[hot], many)])
        rows = _strings(self.buf, self.first, self.last)
        size = self.last - self.first + WINDOW
        lead = np.concatenate([at[plain] - first[plain], np.zeros(len(alone), np.int64)])
        one, number = _distinct(rows, size)
        place = keys[key[plain]] if len(plain) else np.zeros(0, np.uint64)
        if len(hot):
            pad = np.ascontiguousarray(np.pad(rows[len(plain) :, :WINDOW], ((0, 0), (0, 6)))).view(np.uint64)
            place = np.concatenate([place, mix64(pad @ (mix64(np.arange(1, 8, dtype=np.uint64)) | np.uint64(1)))])
        rng = _ranges(place[one], ranges)
        order = np.argsort(rng, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.number = rank[number] if len(number) else number
        self.rows, self.size, self.lead, self.range = rows[one[order]], size[one[order]], lead[one[order]], rng[order]
        self.least = np.full(len(one), NO_ID)
        np.minimum.at(self.least, self.number, self.ids[self.doc])


def _segment_rows(ranges: int):
    def run(runs: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        for r, *packed in zip(*(runs.column(c).to_pylist() for c in ("run", "ids", "offsets", "text"))):
            s = RunSegments(packed, answers, ranges)
            cut = np.flatnonzero(np.diff(s.range, prepend=-1))
            starts = np.cumsum(s.size) - s.size
            inside = np.arange(LONGEST) < s.size[:, None]
            text = _blobs(s.rows[inside], starts[cut] if len(cut) else np.zeros(0, np.int64))
            out.append(pa.table({"range": s.range[cut], "run": np.full(len(cut), r), "text": text, "size": _blobs(s.size.astype(np.uint8), cut), "lead": _blobs(s.lead.astype(np.uint8), cut), "least": _blobs(s.least, cut)}))
        return pa.concat_tables(out)

    return run


# in front of every string; no byte of UTF-8 text is 0xFF
END = np.uint16(0xFFFF)


def window_classes(rows: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, window start, class) of all windows of distinct strings; equal windows share a class, classes ascend.

    ``suffix`` lists the current suffixes in order, as places in the strings' symbols;
    ``bwt`` is the symbol in front of each.
    """
    m, width = rows.shape
    half = width // 2
    symbols = np.full((2 * m, half + 2), END, np.uint16)
    wide = rows.astype(np.uint16)
    symbols[0::2, 1 : half + 1] = (wide[:, 0 : 2 * half : 2] << 8) | wide[:, 1 : 2 * half : 2]
    odd = (width - 1) // 2
    symbols[1::2, 1 : odd + 1] = (wide[:, 1 : 2 * odd : 2] << 8) | wide[:, 2 : 2 * odd + 1 : 2]
    stride = symbols.shape[1]
    flat = symbols.ravel()
    length = np.stack([size // 2, (size - 1) // 2], axis=1).ravel()
    depth, rounds = WINDOW // 2, int(length.max(initial=0))
    empty = (np.arange(2 * m) * stride + 1 + length).astype(np.int32 if 2 * m * stride < 1 << 31 else np.int64)
    suffix = empty
    alike = np.zeros(0, np.int32)
    for r in range(rounds):
        t = r - (rounds - depth)
        if t == 0:
            alike = np.zeros(len(suffix), np.int32)  # all agree in no symbols
        bwt = flat[suffix - 1]
        live = np.flatnonzero(bwt != END)
        bwt = bwt[live]
        order = np.argsort(bwt, kind="stable")
        came = live[order]
        suffix = np.concatenate([empty, suffix[came] - 1])
        if t >= 0:
            sym, was = bwt[order], alike[came]
            new = np.ones(len(suffix), bool)
            new[2 * m + 1 :] = (sym[1:] != sym[:-1]) | (was[1:] != was[:-1])
            alike = np.cumsum(new, dtype=np.int32)
    string = suffix // stride
    at = suffix - string * stride - 1
    whole = np.flatnonzero(length[string] - at >= depth)
    string = string[whole]
    return string >> 1, (string & 1) + 2 * at[whole], alike[whole]


def least_ids(rows: np.ndarray, size: np.ndarray, lead: np.ndarray, least: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smallest ids, first place of each string): for every window of every string in order.

    Equal windows have one anchor string; strings whose anchor string (at ``lead``) no
    other string has are answered by their own id, the rest by their windows' classes.
    """
    windows = size - WINDOW + 1
    begin = np.cumsum(windows) - windows
    out = np.repeat(least, windows)
    anchor = rows[np.arange(len(rows))[:, None], lead[:, None] + np.arange(GRAM)]
    _, number = _distinct(anchor, np.zeros(len(rows), np.int64))
    met = np.flatnonzero(np.bincount(number)[number] > 1) if len(rows) else np.zeros(0, np.int64)
    if len(met):
        string, start, cls = window_classes(rows[met], size[met])
        head = np.flatnonzero(np.diff(cls, prepend=-1))
        best = np.minimum.reduceat(least[met[string]], head)
        out[begin[met[string]] + start] = np.repeat(best, np.diff(np.append(head, len(cls))))
    return out, begin


def _solve(table: pa.Table) -> pa.Table:
    """Answers of a range: per run and segment, runs of windows with one smallest id (counts, lengths, ids)."""
    size, per_row = _flat(table.column("size"), np.uint8)
    size = size.astype(np.int64)
    text, _ = _flat(table.column("text"), np.uint8)
    least, _ = _flat(table.column("least"), np.int64)
    rows = np.zeros((len(size), LONGEST), np.uint8)
    rows[np.arange(LONGEST) < size[:, None]] = text
    one, number = _distinct(rows, size)
    lowest = np.full(len(one), NO_ID)
    np.minimum.at(lowest, number, least)
    lead = _flat(table.column("lead"), np.uint8)[0].astype(np.int64)[one]
    ids, begin = least_ids(rows[one], size[one], lead, lowest)
    windows = size[one] - WINDOW + 1
    # runs of equal ids within each distinct string
    new = np.append(True, ids[1:] != ids[:-1])
    new[begin] = True
    place = np.flatnonzero(new)
    length = np.diff(np.append(place, len(ids)))
    of_string = np.repeat(np.arange(len(one)), windows)[place]
    count = np.bincount(of_string, minlength=len(one))
    start = np.cumsum(count) - count
    # back to the rows' segments
    n = count[number]
    stop = np.cumsum(n)
    pick = np.arange(stop[-1]) + np.repeat(start[number] - (stop - n), n)
    cut = np.cumsum(per_row) - per_row
    cut_runs = (stop - n)[cut]
    return pa.table(
        {
            "run": table.column("run"), "range": table.column("range"), "counts": _blobs(n.astype(np.uint8), cut),
            "lengths": _blobs(length[pick].astype(np.uint8), cut_runs), "least": _blobs(ids[place][pick], cut_runs),
        }
    )


OUT_SCHEMA = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def removed_bytes(s: RunSegments, counts: np.ndarray, lengths: np.ndarray, least: np.ndarray) -> np.ndarray:
    """Mask of the run's bytes that go."""
    delta = np.zeros(len(s.buf) + 1, np.int64)
    if len(s.first):
        start = np.cumsum(counts) - counts
        step = np.cumsum(lengths) - lengths
        within = step - np.repeat(step[start], counts)
        n = counts[s.number]
        stop = np.cumsum(n)
        pick = np.arange(stop[-1]) + np.repeat(start[s.number] - (stop - n), n)
        gone = least[pick] < np.repeat(s.ids[s.doc], n)
        pick, at = pick[gone], np.repeat(s.first, n)[gone]
        np.add.at(delta, at + within[pick], 1)
        np.add.at(delta, at + within[pick] + lengths[pick] - 1 + WINDOW, -1)
    return np.cumsum(delta[:-1]) > 0


def _keep(ranges: int):
    def run(runs: pa.Table, answers: pa.Table) -> pa.Table:
        out = []
        state = answers.filter(pa.compute.is_valid(answers.column("state")))
        found = answers.filter(pa.compute.is_null(answers.column("state")))
        found = found.take(pa.array(np.argsort(found.column("range").to_numpy())))
        for packed in zip(*(runs.column(c).to_pylist() for c in ("ids", "offsets", "text"))):
            s = RunSegments(packed, state, ranges)
            counts, lengths, least = (_flat(found.column(c), k)[0] for c, k in (("counts", np.uint8), ("lengths", np.uint8), ("least", np.int64)))
            gone = removed_bytes(s, counts.astype(np.int64), lengths.astype(np.int64), least)
            total = np.concatenate([[0], np.cumsum(gone, dtype=np.int64)])
            n = np.diff(s.offs)
            n_gone = total[s.offs[1:]] - total[s.offs[:-1]]
            rise = gone & ~np.append(False, gone[:-1])
            rise[s.offs[:-1][n > 0]] = gone[s.offs[:-1][n > 0]]
            edges = np.concatenate([[0], np.cumsum(rise, dtype=np.int64)])
            raw = packed[2]
            sha = []
            for a, z, g in zip(s.offs[:-1].tolist(), s.offs[1:].tolist(), n_gone.tolist()):
                sha.append(hashlib.sha256(s.buf[a:z][~gone[a:z]].tobytes() if g else raw[a:z]).hexdigest())
            out.append(pa.table({"id": pa.array(s.ids, mask=s.ids == NO_ID), "n_bytes": n, "n_removed": n_gone, "n_spans": edges[s.offs[1:]] - edges[s.offs[:-1]], "kept_sha256": pa.array(sha, pa.string())}))
        return pa.concat_tables(out)

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_bytes: int = RUN_BYTES, segments_per_range: int = SEGMENTS_PER_RANGE, hot_docs: int = HOT_DOCS) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    # a bucketed table has a bound on its buckets, and every task writes into as many files
    buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MOST_BUCKETS)
    name = f"llm_runs_{uuid.uuid4().hex}"
    (
        rows.mapInArrow(_runs(run_bytes), RUN_SCHEMA)
        .write.format("parquet").option("path", new_folder(spark, "suffix-runs")).option("compression", "zstd").bucketBy(buckets, "run").saveAsTable(name)
    )
    runs = spark.table(name)
    size = runs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # an anchor serves 16 windows on average
    ranges = max(1, -(-size // (16 * ANCHORS_PER_RANGE)))
    anchors = runs.select("run", "ids", "offsets", "text").mapInArrow(_anchor_rows(ranges), "range long, run long, keys binary, docs binary")
    states = materialize(anchors.groupBy("range").applyInArrow(_shared(hot_docs), "run long, range long, state binary"), "suffix-states")
    spots = max(1, -(-size // (16 * segments_per_range)))
    parts = runs.groupBy("run").cogroup(states.groupBy("run")).applyInArrow(_segment_rows(spots), "range long, run long, text binary, size binary, lead binary, least binary")
    found = parts.groupBy("range").applyInArrow(_solve, "run long, range long, counts binary, lengths binary, least binary")
    found = materialize(found, "suffix-answers")
    answers = states.unionByName(found, allowMissingColumns=True)
    kept = runs.groupBy("run").cogroup(answers.groupBy("run")).applyInArrow(_keep(spots), OUT_SCHEMA)
    return kept.withColumnRenamed("id", id_col)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated 50-byte strings of all documents."""
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP2_SQL = f"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents
), blocks AS (
    SELECT r, doc_id, o, substr(h, (2 * o + 1)::BIGINT, {2 * (256 + WINDOW - 1)}) AS part FROM (SELECT r, doc_id, h, unnest(range(0, len(h) // 2, 256)) AS o FROM d)
), w AS (
    SELECT r, doc_id, o, part, unnest(range(0, len(part) // 2 - {WINDOW - 1})) AS q FROM blocks
), k AS (
    SELECT r, doc_id, o + q AS p, substr(part, (2 * q + 1)::BIGINT, {2 * WINDOW}) AS s FROM w
), low AS (
    SELECT s, min(doc_id) AS low FROM k GROUP BY s HAVING count(*) > 1
), gone AS (
    SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS before FROM k JOIN low USING (s) WHERE low < doc_id OR (doc_id IS NULL AND low IS NOT NULL)
), marked AS (
    SELECT r, p, sum((before IS NULL OR p > before + {WINDOW})::INT) OVER (PARTITION BY r ORDER BY p) AS span FROM gone
), spans AS (
    SELECT r, span, min(p) AS a, max(p) + {WINDOW} AS z FROM marked GROUP BY r, span
), edges AS (
    SELECT r, a, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS from_ FROM spans
    UNION ALL
    SELECT d.r, len(h) // 2, coalesce(max(z), 0) FROM d LEFT JOIN spans USING (r) GROUP BY d.r, h
), kept AS (
    SELECT r, string_agg(substr(h, (2 * from_ + 1)::BIGINT, (2 * (a - from_))::BIGINT), '' ORDER BY a, from_) AS h FROM edges JOIN d USING (r) GROUP BY r
)
SELECT doc_id, len(d.h) // 2 AS n_bytes, (len(d.h) - len(kept.h)) // 2 AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(kept.h)) AS kept_sha256
FROM d JOIN kept USING (r) LEFT JOIN (SELECT r, count(*) AS n FROM spans GROUP BY r) USING (r)
"""
