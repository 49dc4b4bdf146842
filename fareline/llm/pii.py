"""Personal data: base patterns, and a conditional random field over word shapes beside them.

The field (``crf.py``) is trained from a small labelled table (``labelled_table``:
sentences made by rule from span layouts, most of which the base patterns don't know,
and from numbers that are no personal data) and from shape sequences around base matches
of a bounded sample of documents (``SAMPLE_DOCS``, ``SAMPLE_WINDOWS``: documented
bounds). Every whole text is then decoded. A span that the field adds must hold up as
its kind (digits, Luhn, octets, an address) and may not touch a base match, or lie
within a failed match of its own kind.

Spans are in code points, end exclusive. Defined results: a null text counts as empty;
null and repeated ids keep one row per input row; a very long text is decoded in
sequences cut at plain words, so that its length costs no more than its words; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import SPACE_SPLIT, Words, byte_table, chunks, text_buffer
from fareline.llm.crf import LABELS, PLAIN, Crf, shapes, train

KINDS = LABELS[1:]
# distinct documents, and windows of tokens in them, that the field is fitted on beside the table
SAMPLE_DOCS, SAMPLE_WINDOWS, WINDOW_TOKENS = 600, 2400, 10
TABLE_ROWS, TABLE_SEED = 900, 6
PIECE_TOKENS = 64

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_HINT = byte_table(b"0123456789@")

# span layouts of the labelled table: "d" a digit, "o" an octet, "w" a word, "C" the four
# groups of a card number, joined by the mark after it
LAYOUTS = {
    "phone": ("ddd-ddd-dddd", "(ddd) ddd-dddd", "ddd.ddd.dddd", "ddd ddd dddd", "00dd dd dddd dddd", "+d ddd ddd dddd", "+dd (ddd) ddd-dddd"),
    "card": ("C.", "C_", "C/", "C ", "C-", "C"),
    "email": ("w@w", "w.w@w-w", "w@w.w", "w_w@w.w.w", "w+d@w.w"),
    "ip": ("o-o-o-o", "o.o.o.o", "o:o:o:o"),
}
# numbers and marks that are none; what a kind's own test refuses anyway isn't listed
OTHERS = (
    "dddd-dd-dd", "d/d/dddd", "dd.dd.dddd", "d:dd", "d.dd", "d,ddd", "d,ddd,ddd.dd", "dddd", "dddddd", "ddddddddd", "ddddddddddd", "#ddddd", "d-d", "ddd-ddd", "dd-dddd",
    "vd.d.d", "d.d.d", "d%", "dd.d", "w-w", "w/w", "@ d", "w:d", "(d)", "(dddd)", "dddd_dd", "dddd.dddd", "+d", "d+d", "d x d",
)


def _fill(layout: str, rnd: random.Random) -> str:
    """A layout with its places filled in."""
    if layout[0] == "C":
        body = [rnd.randrange(10) for _ in range(15)]
        last = next(c for c in range(10) if luhn("".join(map(str, [*body, c]))))
        text = "".join(map(str, [*body, last]))
        return layout[1:].join(text[i : i + 4] for i in range(0, 16, 4))
    places = {"d": lambda: str(rnd.randrange(10)), "o": lambda: str(rnd.randrange(256)), "w": lambda: "".join(rnd.choice("abcdefghijklmnoprstuvy") for _ in range(rnd.randrange(3, 9)))}
    return "".join(places[c]() if c in places else c for c in layout)


def labelled_table(rows: int = TABLE_ROWS, seed: int = TABLE_SEED) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Sentences with the code point spans of their personal data: (text, [(start, end, kind), ...])."""
    rnd = random.Random(seed)
    layouts = [(kind, x) for kind, xs in LAYOUTS.items() for x in xs] + [(None, x) for x in OTHERS]
    out = []
    for i in range(rows):
        text, spans = "", []
        for k in range(rnd.choice((1, 1, 2, 3))):
            kind, layout = layouts[(i + k * 7) % len(layouts)] if k == 0 else rnd.choice(layouts)
            lead = " ".join(_fill("w", rnd) for _ in range(rnd.randrange(0 if k == 0 else 1, 6)))
            text += (" " if text else "") + lead + (" " if lead else "")
            piece = _fill(layout, rnd)
            # a number may not read as another kind by chance
            while any(ok and KINDS[j] != kind for j, _, _, ok in base_matches(piece)):
                piece = _fill(layout, rnd)
            if kind:
                spans.append((len(text), len(text) + len(piece), kind))
            text += piece + rnd.choice(("", "", "", ".", ",", ";"))
        tail = " ".join(_fill("w", rnd) for _ in range(rnd.randrange(6)))
        out.append((text + (" " + tail if tail else ""), spans))
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return re.sub("[^0-9]", "", s)


def holds(kind: str, s: str) -> bool:
    """Whether text of a kind passes that kind's test."""
    d = _digits(s)
    if kind == "email":
        return bool(re.fullmatch(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)*", s))
    if kind == "ip":
        parts = re.findall("[0-9]+", s)
        return len(parts) == 4 and _octets_hold(".".join(parts))
    if kind == "card":
        return 12 <= len(d) <= 19 and luhn(d)
    return 9 <= len(d) <= 15


def _octets_hold(s: str) -> bool:
    # leading zeros don't change a part's value; int() of a very long part is avoided
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def base_matches(text: str) -> Iterator[tuple[int, int, int, bool]]:
    """(kind, start, end, passes) of the base patterns, kind by kind, leftmost and not overlapping.

    An e-mail's local part can't hold an @, so each @ decides a match by itself: the
    local characters before it, back to the last match or @, and the domain after it.
    """
    floor, at = 0, text.find("@")
    while at >= 0:
        head = text[floor:at]
        start = floor + len(head.rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield 0, start, m.end(), True
        floor = m.end() if m else at + 1
        at = text.find("@", floor)
    if "." in text:
        for m in _IP.finditer(text):
            yield 1, m.start(), m.end(), _octets_hold(m[0])
    for m in _CARD.finditer(text):
        d = _digits(m[0])
        yield 2, m.start(), m.end(), 12 <= len(d) <= 19 and luhn(d)
    if "+" in text:
        for m in _PHONE.finditer(text):
            yield 3, m.start(), m.end(), 9 <= len(_digits(m[0])) <= 15


def pieces(words: Words, code: np.ndarray) -> np.ndarray:
    """First tokens of the sequences: documents, cut at the first plain word after every PIECE_TOKENS tokens."""
    n = len(code)
    if n == 0:
        return np.zeros(0, np.int64)
    within = np.arange(n) - words.first[:-1][words.doc]
    plain = np.flatnonzero(code == PLAIN)
    due = np.flatnonzero(within % PIECE_TOKENS == 0)
    k = np.searchsorted(plain, due)
    cut = np.append(plain, -1)[k]
    cut = cut[(k < len(plain)) & (words.doc[cut] == words.doc[due])]
    starts = words.first[:-1][np.diff(words.first) > 0]
    return np.unique(np.concatenate([starts, cut]))


def _runs(label: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int]]:
    """Token ranges of equal labels other than O within a document."""
    on = np.flatnonzero(label > 0)
    if len(on):
        new = np.append(True, (np.diff(on) > 1) | (np.diff(label[on]) != 0) | (np.diff(doc[on]) != 0))
        first = on[new]
        last = on[np.append(np.flatnonzero(new)[1:] - 1, len(on) - 1)]
        yield from zip(first.tolist(), (last + 1).tolist())


def _trimmed(piece: str) -> tuple[int, int]:
    """A piece without marks around it; a bracket that is closed inside it stays."""
    left = len(piece) - len(piece.lstrip("([{<\"'"))
    if left and piece[left - 1] == "(" and ")" in piece[left:-1].rstrip(".,;:!?)]}>\"'"):
        left -= 1
    return left, len(piece.rstrip(".,;:!?)]}>\"'"))


def document_spans(buf: np.ndarray, offs: np.ndarray, model: Crf) -> Iterator[tuple[int, list, list]]:
    """(document, base spans, added spans) of the documents that have any; spans are (start, end, kind)."""
    words = Words(buf, offs, SPACE_SPLIT)
    hint = np.concatenate([[0], np.cumsum(_HINT[buf])])
    maybe = set(np.flatnonzero(hint[offs[1:]] > hint[offs[:-1]]).tolist())
    code = shapes(buf, words.starts, words.ends)
    label = model.decode(code, pieces(words, code))
    guesses: dict[int, list] = {}
    for a, z in _runs(label, words.doc):
        guesses.setdefault(int(words.doc[a]), []).append((int(words.starts[a]), int(words.ends[z - 1]), int(label[a]) - 1))
    for d in sorted(maybe | guesses.keys()):
        raw = buf[offs[d] : offs[d + 1]].tobytes()
        text = raw.decode()
        found = list(base_matches(text)) if d in maybe else []
        base = sorted((s, e, k) for k, s, e, ok in found if ok)
        taken = [(s, e, None if ok else k) for k, s, e, ok in found]
        added = []
        for s, e, k in guesses.get(d, ()):
            piece = raw[s - offs[d] : e - offs[d]].decode()
            left, right = _trimmed(piece)
            if left < right and holds(KINDS[k], piece[left:right]):
                at = len(raw[: s - offs[d]].decode())
                span = (at + left, at + right, k)
                # not beside or within a base match; not within a match of its own kind that failed the test
                if all(span[1] <= a or z <= span[0] if failed is None else failed != k or span[0] < a or z < span[1] for a, z, failed in taken):
                    added.append(span)
        if base or added:
            yield d, base, added


def joined(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], x[2], x[1])))


EMPTY_SHA = hashlib.sha256(b"").hexdigest()
SPAN_SCHEMA = "id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long"


def _tag(model_b):
    def run(batches):
        model = model_b.value
        for b in batches:
            buf, offs = text_buffer(b.column(1))
            for first, last in chunks(offs):
                n = last - first
                counts = np.zeros((5, n), np.int64)
                sha, spans = [EMPTY_SHA] * n, [""] * n
                for d, base, added in document_spans(buf[offs[first] : offs[last]], offs[first : last + 1] - offs[first], model):
                    for _, _, k in base:
                        counts[k, d] += 1
                    counts[4, d] = len(added)
                    sha[d] = hashlib.sha256(joined(base).encode()).hexdigest()
                    spans[d] = joined(base + added)
                yield pa.record_batch(
                    [b.column(0)[first:last], *(pa.array(counts[k]) for k in range(4)), pa.array(sha), pa.array(spans), pa.array(counts[4])],
                    names=["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_added"],
                )

    return run


def _redact(model_b, text_at: int, chars_at: int | None):
    def run(batches):
        model = model_b.value
        for b in batches:
            column = b.column(text_at)
            buf, offs = text_buffer(column)
            changed = {}
            for first, last in chunks(offs):
                for d, base, added in document_spans(buf[offs[first] : offs[last]], offs[first : last + 1] - offs[first], model):
                    text, out, at = column[first + d].as_py(), [], 0
                    for s, e, k in sorted(base + added):
                        if e > at:
                            out += [text[at : max(s, at)], f"[{KINDS[k].upper()}]" if s >= at else ""]
                            at = e
                    changed[first + d] = "".join(out) + text[at:]
            if changed:
                texts = column.to_pylist()
                for i, t in changed.items():
                    texts[i] = t
                columns = list(b.columns)
                columns[text_at] = pa.array(texts, column.type)
                if chars_at is not None:
                    sizes = columns[chars_at].to_pylist()
                    for i, t in changed.items():
                        sizes[i] = len(t)
                    columns[chars_at] = pa.array(sizes, columns[chars_at].type)
                b = pa.RecordBatch.from_arrays(columns, schema=b.schema)
            yield b

    return run


def _labelled(batches):
    """Labelled windows of sampled documents: around base matches, and the document's first tokens."""
    for b in batches:
        for text in b.column(0).to_pylist():
            rows = [s for s in label_windows(text or "") if len(s[0])]
            if rows:
                yield pa.record_batch([pa.array([c.tolist() for c, _ in rows], pa.list_(pa.int64())), pa.array([y.tolist() for _, y in rows], pa.list_(pa.int64()))], names=["code", "label"])


def _tokens(text: str, spans) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """(shape codes, labels, token ranges) of a text with (start, end, label) spans in code points."""
    raw = text.encode()
    buf = np.frombuffer(raw, np.uint8)
    words = Words(buf, np.array([0, len(raw)]), SPACE_SPLIT)
    label, ranges = np.zeros(len(words.starts), np.int64), []
    for s, e, y in spans:
        a, z = len(text[:s].encode()), len(text[:e].encode())
        first, last = int(np.searchsorted(words.ends, a, side="right")), int(np.searchsorted(words.starts, z, side="left"))
        if y:
            label[first:last] = y
        ranges.append((first, last))
    return shapes(buf, words.starts, words.ends), label, ranges


def label_windows(text: str) -> list[tuple[np.ndarray, np.ndarray]]:
    """Windows around a text's base matches and its first tokens; long ones in pieces."""
    code, label, ranges = _tokens(text, [(s, e, k + 1 if ok else 0) for k, s, e, ok in base_matches(text)])
    spans = [(max(0, a - WINDOW_TOKENS), min(len(code), z + WINDOW_TOKENS)) for a, z in ranges] + [(0, min(len(code), WINDOW_TOKENS))]
    step = 4 * WINDOW_TOKENS
    return [(code[i : min(z, i + step)], label[i : min(z, i + step)]) for a, z in spans for i in range(a, z, step)]


def table_windows(table) -> list[tuple[np.ndarray, np.ndarray]]:
    """The labelled table's rows as shape codes and labels."""
    return [_tokens(text, [(s, e, LABELS.index(kind)) for s, e, kind in spans])[:2] for text, spans in table]


def spans_of(text: str, model: Crf) -> list[tuple[int, int, str]]:
    """All spans of one text, base ones and added ones."""
    raw = text.encode()
    found = document_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]), model)
    return sorted((s, e, KINDS[k]) for _, base, added in found for s, e, k in base + added)


def evaluate(model: Crf, table) -> dict[str, tuple[float, float]]:
    """(precision, recall) of whole spans per kind over labelled rows."""
    hits, given, wanted = Counter(), Counter(), Counter()
    for text, spans in table:
        got, want = set(spans_of(text, model)), set(spans)
        given.update(k for _, _, k in got)
        wanted.update(k for _, _, k in want)
        hits.update(k for _, _, k in got & want)
    return {k: (hits[k] / max(given[k], 1), hits[k] / max(wanted[k], 1)) for k in KINDS}


def train_from(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS, sample_windows: int = SAMPLE_WINDOWS, table=None) -> Crf:
    """A field trained on the labelled table and on about ``sample_docs`` distinct texts with digits or an @, chosen by hash."""
    text = F.col(text_col)
    marked = docs.select(text.alias("text")).where(text.rlike("[0-9@]"))
    n = marked.count()
    if n > sample_docs:
        marked = marked.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int((1 << 30) * sample_docs / n))
    # copies of one text, however many, are one row of the sample
    marked = marked.groupBy(F.xxhash64("text").alias("h")).agg(F.min("text").alias("text")).select("text")
    rows = marked.mapInArrow(_labelled, "code array<long>, label array<long>").limit(sample_windows).collect()
    sequences = [(np.array(r.code, np.int64), np.array(r.label, np.int64)) for r in sorted(rows, key=lambda r: (r.code, r.label))]
    return train(sequences + table_windows(labelled_table() if table is None else table))


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Crf | None = None) -> DataFrame:
    """Base counts and digest and all spans per row of ``docs``."""
    model = model or train_from(docs, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_tag(docs.sparkSession.sparkContext.broadcast(model)), SPAN_SCHEMA).withColumnRenamed("id", id_col)


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", model: Crf | None = None) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets; ``chars_col`` follows the new length."""
    model = model or train_from(docs, text_col)
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else None
    return docs.mapInArrow(_redact(docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col), chars), docs.schema)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
