"""Quality and toxicity classifier by co-training of two views.

View 1 (text content) has the presence of words and word beginnings that go with the
labels in the sample (as 32-bit hashes), and shares of letters, capitals, digits, marks and repeated words. View 2 (page
metadata) has the source, the language and the length class. Each view has its own
logistic model for each target. They are fitted on a bounded sample of labelled rows
(``LABELLED``) and, over rounds, give each other their most confident labels for a
bounded pool of unlabelled documents (``POOL``). Each view's log-odds are calibrated on
labelled rows held back from fitting; the views' evidence adds up beyond the prior.
Every whole text of the table is then scored.

Both samples are chosen by a hash of the id at a rate that fits their bound; below the
bound every row is taken.

Defined results: a null or empty text has no words and zero shares; null metadata is a
value of its own; null and repeated ids keep one row per input row; labels that
disagree count as low quality and as toxic, null labels don't count; without labels of
both kinds a target's score is its prior (accepted if there are none); an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import ALNUM_WORD, LOWER, Words, byte_table, chunks, materialize, mix64, text_buffer

LABELLED, POOL = 12000, 4000
ROUNDS, GIVEN_SHARE, SURE = 3, 0.05, 0.97
# a document is rejected when either target is likelier than this
REJECT = 0.4
WORDS_PER_TARGET, LEAST_DOCS = 600, 5
# bytes of a word beginning
BEGINNING = 6
TARGETS = ("bad", "toxic")
LENGTH_CLASSES = 24

_UPPER = byte_table(range(0x41, 0x5B))
_LETTER = byte_table([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
_DIGIT = byte_table(range(0x30, 0x3A))
_SPACE = byte_table([0x20, *range(0x09, 0x0E)])
_STOP = byte_table(b".,")
_LOUD = byte_table(b"!?")
_PIPE = byte_table(b"|")
SHARES = 10


def _sums(table: np.ndarray, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Bytes of a class in each document."""
    seen = np.concatenate([[0], np.cumsum(table[buf], dtype=np.int64)])
    return seen[offs[1:]] - seen[offs[:-1]]


def shares(buf: np.ndarray, offs: np.ndarray, w: Words) -> np.ndarray:
    """Per document: shares of bytes by class, log of words, word length, share of distinct words."""
    n = np.diff(offs)
    size = np.maximum(n, 1)
    upper, letter, digit, space, stop, loud, pipe = (_sums(t, buf, offs) for t in (_UPPER, _LETTER, _DIGIT, _SPACE, _STOP, _LOUD, _PIPE))
    words = np.diff(w.first)
    distinct = np.zeros(len(n))
    if len(w.hash):
        order = np.lexsort((w.hash, w.doc))
        h, d = w.hash[order], w.doc[order]
        new = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1]))
        distinct = np.bincount(d[new], minlength=len(n))
    marks = n - letter - digit - space - stop - loud - pipe
    out = np.stack(
        [
            upper / np.maximum(letter, 1), digit / size, space / size, stop / size, loud / size, pipe / size, marks / size,
            np.log1p(words) / 10, letter / np.maximum(words, 1) / 20, distinct / np.maximum(words, 1),
        ],
        axis=1,
    )
    return out.astype(np.float32)


def marks_of(buf: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """(hash, document) of every word and every beginning of a longer word."""
    long = np.flatnonzero(w.ends - w.starts > BEGINNING)
    key = np.zeros(len(long), np.uint64)
    for k in range(BEGINNING):
        key = (key << np.uint64(8)) | LOWER[buf[w.starts[long] + k]]
    return np.concatenate([w.hash.astype(np.uint32), mix64(key + np.uint64(1)).astype(np.uint32)]), np.concatenate([w.doc, w.doc[long]])


def meta_keys(lang, source, n_chars) -> list[str]:
    """One-hot features of the metadata view."""
    length = "none" if n_chars is None else str(min(LENGTH_CLASSES, max(0, int(n_chars)).bit_length()))
    return [f"lang={lang}", f"source={source}", f"length={length}"]


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1.0, rounds: int = 200) -> np.ndarray:
    """Weights (the last one the intercept) by accelerated gradient steps on the penalised likelihood."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    w = np.zeros(x.shape[1], np.float32)
    # the largest curvature, by power iteration
    v = np.ones(x.shape[1], np.float32)
    for _ in range(12):
        v = x.T @ (weight * (x @ v))
        top = float(np.linalg.norm(v)) or 1.0
        v /= top
    step, ahead, t = 1 / (0.25 * top * 1.05 + penalty), w, 1.0
    for _ in range(rounds):
        g = x.T @ (weight * (sigmoid(x @ ahead) - y)) + penalty * np.append(ahead[:-1], 0)
        new = (ahead - step * g).astype(np.float32)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = (new + (t - 1) / t2 * (new - w)).astype(np.float32)
        w, t = new, t2
    return w


def calibrate(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (not negative) and offset of the calibrated log-odds."""
    w = fit_logistic(score[:, None].astype(np.float32) / 4, y, np.ones(len(y), np.float32), penalty=0.1)
    return max(0.0, float(w[0]) / 4), float(w[1]) if w[0] > 0 else prior_odds(y)


def prior_odds(y: np.ndarray) -> float:
    p = (y.sum() + 0.5) / (len(y) + 1)
    return float(np.log(p / (1 - p)))


@dataclass
class Target:
    """Models of one target; without both kinds of labels only the prior counts."""

    prior: float | None = None
    text: np.ndarray | None = None  # words, shares, intercept
    meta: np.ndarray | None = None
    text_cal: tuple[float, float] = (1.0, 0.0)
    meta_cal: tuple[float, float] = (1.0, 0.0)

    def combine(self, text_score: np.ndarray, meta_score: np.ndarray) -> np.ndarray:
        """Calibrated log-odds of both views together."""
        a = self.text_cal[0] * text_score + self.text_cal[1]
        b = self.meta_cal[0] * meta_score + self.meta_cal[1]
        return a + b - self.prior


@dataclass
class Views:
    words: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))  # sorted hashes
    meta: dict[str, int] = field(default_factory=dict)
    mean: np.ndarray = field(default_factory=lambda: np.zeros(SHARES, np.float32))
    scale: np.ndarray = field(default_factory=lambda: np.ones(SHARES, np.float32))
    targets: dict[str, Target] = field(default_factory=dict)


def _features(batches):
    """Sample rows: (id, lang, source, n_chars, bad, toxic, shares, distinct word hashes)."""
    for b in batches:
        buf, offs = text_buffer(b.column(0))
        for first, last in chunks(offs):
            part, o = buf[offs[first] : offs[last]], offs[first : last + 1] - offs[first]
            w = Words(part, o, ALNUM_WORD)
            s = shares(part, o, w)
            h, doc = marks_of(part, w)
            pair = np.unique((doc.astype(np.uint64) << np.uint64(32)) | h)
            cut = np.searchsorted(pair, np.arange(last - first + 1, dtype=np.uint64) << np.uint64(32))
            hashes = [pair[a:z].astype(np.uint32).tobytes() for a, z in zip(cut[:-1], cut[1:])]
            yield pa.record_batch(
                [*(b.column(k)[first:last] for k in range(1, 7)), pa.array([x.tobytes() for x in s], pa.binary()), pa.array(hashes, pa.binary())],
                names=["id", "lang", "source", "n_chars", "bad", "toxic", "shares", "words"],
            )


SAMPLE_SCHEMA = "id long, lang string, source string, n_chars long, bad int, toxic int, shares binary, words binary"


def choose_words(docs_words: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """Words whose presence goes with a label: the largest chi-squared statistics."""
    words, count = np.unique(np.concatenate([*docs_words, np.zeros(0, np.uint32)]), return_counts=True)
    words = words[count >= LEAST_DOCS]
    if not len(words):
        return words
    pos = np.zeros(len(words))
    neg = np.zeros(len(words))
    for h, label in zip(docs_words, y):
        at = np.minimum(np.searchsorted(words, h), len(words) - 1)
        hit = at[words[at] == h]
        (pos if label else neg)[hit] += 1
    # chi-squared of presence against label
    absent_pos, absent_neg = y.sum() - pos, len(y) - y.sum() - neg
    rows = (pos + neg) * (absent_pos + absent_neg) * float(max(1, y.sum())) * float(max(1, len(y) - y.sum()))
    chi = len(y) * (pos * absent_neg - neg * absent_pos) ** 2 / np.maximum(rows, 1)
    return np.sort(words[np.argsort(-chi, kind="stable")[:WORDS_PER_TARGET]])


def presence(docs_words: list[np.ndarray], words: np.ndarray) -> np.ndarray:
    out = np.zeros((len(docs_words), len(words)), np.float32)
    for i, h in enumerate(docs_words):
        at = np.searchsorted(h, words)
        ok = at < len(h)
        out[i, ok] = h[at[ok]] == words[ok]
    return out


def co_train(sample: list) -> Views:
    """Fit both views from sample rows; ``bad``/``toxic`` are null in the unlabelled pool."""
    rows = sorted(sample, key=lambda r: (r.id, r.words))
    views = Views()
    if not rows:
        return views
    hashes = [np.frombuffer(r.words, np.uint32) for r in rows]
    share = np.stack([np.frombuffer(r.shares, np.float32) for r in rows])
    views.mean, views.scale = share.mean(axis=0), share.std(axis=0) + 1e-3
    share = (share - views.mean) / views.scale
    labels = {t: np.array([-1 if getattr(r, t) is None else getattr(r, t) for r in rows]) for t in TARGETS}
    views.words = np.unique(np.concatenate([choose_words([h for h, k in zip(hashes, y >= 0) if k], y[y >= 0]) for y in labels.values()]))
    x1 = np.concatenate([presence(hashes, views.words), share], axis=1).astype(np.float32)
    keys = [meta_keys(r.lang, r.source, r.n_chars) for r in rows]
    views.meta = {k: i for i, k in enumerate(sorted({k for ks in keys for k in ks}))}
    x2 = np.zeros((len(rows), len(views.meta)), np.float32)
    for i, ks in enumerate(keys):
        x2[i, [views.meta[k] for k in ks]] = 1
    # a fifth of the labelled rows are held back for calibration
    back = np.array([r.id % 5 == 0 for r in rows])
    for name, y in labels.items():
        views.targets[name] = _co_train_target(x1, x2, y, back)
    return views


def _co_train_target(x1, x2, y, back) -> Target:
    known = y >= 0
    if not known.any():
        return Target()
    out = Target(prior=prior_odds(y[known]))
    if len(set(y[known & ~back])) < 2:
        return out
    seen = [known & ~back, known & ~back]
    given = [y.clip(0).astype(np.float32), y.clip(0).astype(np.float32)]
    pool = ~known
    share = float(y[known].mean())
    for r in range(ROUNDS + 1):
        fitted = [fit_logistic(x[s], g[s], np.ones(int(s.sum()), np.float32)) for x, s, g in zip((x1, x2), seen, given)]
        if r == ROUNDS or not pool.any():
            break
        for view, other in ((0, 1), (1, 0)):
            p = sigmoid((x1, x2)[view] @ fitted[view][:-1] + fitted[view][-1])
            free = pool & ~seen[other]
            quota = GIVEN_SHARE * pool.sum()
            for label, sure, part in ((1, p, share), (0, 1 - p, 1 - share)):
                order = np.argsort(-np.where(free, sure, -1), kind="stable")[: int(np.ceil(quota * part))]
                order = order[free[order] & (sure[order] >= SURE)]
                seen[other][order] = True
                given[other][order] = label
    out.text, out.meta = fitted
    held = known & back
    if len(set(y[held])) == 2:
        scores = [(x[held] @ w[:-1] + w[-1]) for x, w in zip((x1, x2), fitted)]
        out.text_cal, out.meta_cal = (calibrate(s, y[held].astype(np.float32)) for s in scores)
    else:
        out.meta_cal = (0.0, out.prior)
    return out


def document_odds(buf, offs, meta: list[list[str]], views: Views) -> dict[str, np.ndarray]:
    """Log-odds of every target for a run of documents (nan without any labels)."""
    w = Words(buf, offs, ALNUM_WORD)
    n = len(offs) - 1
    x = (shares(buf, offs, w) - views.mean) / views.scale
    hit, doc = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(views.words) and len(w.hash):
        h, of = marks_of(buf, w)
        seen = np.zeros(1 << 16, bool)
        seen[views.words & np.uint32(0xFFFF)] = True
        maybe = np.flatnonzero(seen[h & np.uint32(0xFFFF)])
        at = np.minimum(np.searchsorted(views.words, h[maybe]), len(views.words) - 1)
        on = views.words[at] == h[maybe]
        pair = np.unique(of[maybe[on]] * len(views.words) + at[on])
        doc, hit = pair // len(views.words), pair % len(views.words)
    places = [[views.meta[k] for k in ks if k in views.meta] for ks in meta]
    out = {}
    for name in TARGETS:
        t = views.targets.get(name, Target())
        if t.text is None:
            out[name] = np.full(n, np.nan if t.prior is None else t.prior)
            continue
        k = len(views.words)
        text = np.bincount(doc, weights=t.text[:k][hit], minlength=n) + x @ t.text[k:-1] + t.text[-1]
        page = np.array([t.meta[p].sum() + t.meta[-1] for p in places])
        out[name] = t.combine(text, page)
    return out


def _decide(b: pa.RecordBatch, at: dict[str, int | None], views: Views):
    """(p_quality, p_toxic, accepted) of a batch; ``at``: places of text, lang, source, n_chars."""
    buf, offs = text_buffer(b.column(at["text"]))
    none = [None] * b.num_rows
    meta = [meta_keys(*r) for r in zip(*(none if at[c] is None else b.column(at[c]).to_pylist() for c in ("lang", "source", "n_chars")))]
    parts = [document_odds(buf[offs[a] : offs[z]], offs[a : z + 1] - offs[a], meta[a:z], views) for a, z in chunks(offs)]
    bad, toxic = (sigmoid(np.concatenate([p[t] for p in parts])) if parts else np.zeros(0) for t in TARGETS)
    return 1 - bad, toxic, ~((bad > REJECT) | (toxic > REJECT))  # nan: no labels, nothing to reject by


def _score(views_b):
    def run(batches):
        for b in batches:
            quality, toxic, accepted = _decide(b, {"text": 1, "lang": 2, "source": 3, "n_chars": 4}, views_b.value)
            yield pa.record_batch(
                [b.column(0), *(pa.array(p, mask=np.isnan(p)) for p in (quality, toxic)), pa.array(accepted)], names=["id", "p_quality", "p_toxic", "accepted"]
            )

    return run


def _accept(views_b, at):
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_decide(b, at, views_b.value)[2]))

    return run


def draw_sample(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED, pool: int = POOL, id_col: str = "doc_id", text_col: str = "text") -> list:
    """At most about ``labelled`` labelled rows and ``pool`` unlabelled ones, by a hash of the id."""
    meta = {c: (F.col(c) if c in docs.columns else F.lit(None)) for c in ("lang", "source", "n_chars")}
    rows = docs.where(F.col(id_col).isNotNull()).select(
        F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("id"), meta["lang"].cast("string").alias("lang"),
        meta["source"].cast("string").alias("source"), meta["n_chars"].cast("long").alias("n_chars"),
    )
    truth = (
        labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg((1 - F.min("quality")).cast("int").alias("bad"), F.max("toxic").cast("int").alias("toxic"))
        .where("bad is not null or toxic is not null")
    )
    span = 1 << 30
    place = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(span))

    def rate(n: int, bound: int) -> int:
        return span if n <= bound else int(span * bound / n)

    n_docs, n_truth = rows.count(), truth.count()
    chosen = truth.where(place < rate(n_truth, labelled))
    # documents outside the labels, at a rate for twice the pool: a part of them has labels
    free = rows.select("id").where(place < rate(n_docs, 2 * pool)).join(truth.select("id"), "id", "left_anti")
    n_free = free.count()
    free = free.where(F.pmod(F.xxhash64("id", F.lit(12)), F.lit(span)) < rate(n_free, pool))
    none = F.lit(None).cast("int")
    wanted = materialize(chosen.unionByName(free.select("id", none.alias("bad"), none.alias("toxic"))), "sample")
    found = rows.join(F.broadcast(wanted), "id")  # bounded by the rates above
    # an id that many rows repeat is one row of the sample, its smallest
    found = found.groupBy("id").agg(F.min(F.struct("text", "lang", "source", "n_chars", "bad", "toxic")).alias("row")).select("row.text", "id", "row.lang", "row.source", "row.n_chars", "row.bad", "row.toxic")
    return found.mapInArrow(_features, SAMPLE_SCHEMA).collect()


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", views: Views | None = None, **sample) -> DataFrame:
    """(id, p_quality, p_toxic, accepted) per row of ``docs``."""
    views = views or co_train(draw_sample(docs, labels, id_col=id_col, text_col=text_col, **sample))
    meta = [(F.col(c) if c in docs.columns else F.lit(None)).cast(k).alias(c) for c, k in (("lang", "string"), ("source", "string"), ("n_chars", "long"))]
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), *meta)
    out = rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(views)), "id long, p_quality double, p_toxic double, accepted boolean")
    return out.withColumnRenamed("id", id_col)


def keep_accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", views: Views | None = None, **sample) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    views = views or co_train(draw_sample(docs, labels, id_col=id_col, text_col=text_col, **sample))
    at = {"text": docs.columns.index(text_col)} | {c: docs.columns.index(c) if c in docs.columns else None for c in ("lang", "source", "n_chars")}
    return docs.mapInArrow(_accept(docs.sparkSession.sparkContext.broadcast(views), at), docs.schema)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality and toxicity of every document."""
    return classify(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
