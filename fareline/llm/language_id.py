"""Language identification of pages by Bayesian fusion of evidence.

- Text: hashed byte-trigram likelihoods per language, counted over all documents with a
  declared language. A page's log-likelihoods are scaled to a bounded effective length,
  as neighbouring trigrams aren't independent.
- Declared markup language, address suffix and language step of the path: the
  likelihood of a value under a language, from the soft counts that the text gives over
  all pages (grouped sums, add-one smoothing).
- Host: a prior from the soft counts of the host's other pages, smoothed towards its
  registered domain, which is smoothed towards the whole collection.

Posterior = prior x likelihoods, normalised. All counts are grouped aggregates over
all rows; only tables of (languages x trigram cells) and one total row reach the driver.

Defined results: without text the text evidence is neutral, without an address or
declaration that evidence is; pages without an id keep their row; repeated pages count
as often as they stand there; without labelled documents the language is null; ties go
to the first language by name; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.llm.common import LOWER, byte_table, chunks, materialize, text_buffer

CELLS = 1 << 14
EFFECTIVE_TRIGRAMS = 40
HOST_WEIGHT, DOMAIN_WEIGHT = 5.0, 20.0
MOST_LANGUAGES = 512
# cells are added up in so many blocks, and in so many partial sums of each
BLOCKS, SUM_SALTS = 16, 32
# Second-level labels under which country registries register names.
REGISTRY_LABELS = ("ac", "co", "com", "edu", "gob", "gov", "net", "nom", "or", "org")

_FOLD = np.where(byte_table([*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]), LOWER, np.uint8(0x20))


def trigram_cells(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cell, document) of every byte trigram within a document; marks, digits and spaces count as one space."""
    b = _FOLD[buf].astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (b[:-2] << 16) | (b[1:-1] << 8) | b[2:]
    blank = (b[:-2] == 0x20) & (b[1:-1] == 0x20)
    cell = ((code * np.uint32(2654435761)) >> np.uint32(32 - 14)).astype(np.int64)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))
    ok = (doc[:-2] == doc[2:]) & ~blank
    return cell[ok], doc[:-2][ok]


def _count(batches):
    totals: dict[str, np.ndarray] = {}
    for b in batches:
        langs = np.array(b.column(0).to_pylist(), object)
        buf, offs = text_buffer(b.column(1))
        for first, last in chunks(offs):
            cell, doc = trigram_cells(buf[offs[first] : offs[last]], offs[first : last + 1] - offs[first])
            names = langs[first:last]
            for lang in set(names):
                mine = (names == lang)[doc]
                totals[lang] = totals.get(lang, 0) + np.bincount(cell[mine], minlength=CELLS)
    salt = TaskContext.get().partitionId() % SUM_SALTS
    for lang, n in totals.items():
        for block, part in enumerate(n.reshape(BLOCKS, -1)):
            if part.any():
                yield _block(lang, block, salt, part)


def _block(lang: str, block: int, salt: int, counts: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([lang]), pa.array([block], pa.int32()), pa.array([salt], pa.int32()), pa.array([counts.tobytes()], pa.binary())], names=["lang", "block", "salt", "counts"])


def _add(batches):
    """Adds up a partition's rows by language and block of cells, one sum in memory for each."""
    total: dict[tuple, np.ndarray] = {}
    for b in batches:
        for lang, block, salt, raw in zip(*(b.column(c).to_pylist() for c in ("lang", "block", "salt")), b.column("counts")):
            n = np.frombuffer(raw.as_buffer(), np.int64)
            key = (lang, block, salt)
            total[key] = total[key] + n if key in total else n.copy()
    for (lang, block, salt), n in total.items():
        yield _block(lang, block, salt, n)


def trigram_model(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """(languages by name, log-probabilities [language, cell]) over all labelled documents."""
    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    n_langs = rows.select("lang").distinct().count()
    if n_langs > MOST_LANGUAGES:
        raise ValueError(f"{n_langs} languages; this model holds {MOST_LANGUAGES}")
    # sums by language and block of cells, in two steps: no task adds up all tasks' rows of a block
    schema = "lang string, block int, salt int, counts binary"
    parts = rows.mapInArrow(_count, schema).repartition("lang", "block", "salt").mapInArrow(_add, schema)
    found = parts.withColumn("salt", F.lit(0)).repartition("lang", "block").mapInArrow(_add, schema).collect()
    names = sorted(r.lang for r in rows.select("lang").distinct().collect())  # MOST_LANGUAGES at most
    n = np.full((len(names), BLOCKS, CELLS // BLOCKS), 0.5)
    for r in found:
        n[names.index(r.lang), r.block] += np.frombuffer(r.counts, np.int64)
    n = n.reshape(len(names), CELLS)
    return names, np.log(n / n.sum(axis=1, keepdims=True))


def _likelihoods(model_b):
    """Scaled log-likelihoods of the languages per page; none for pages without trigrams."""

    def run(batches):
        logp = model_b.value
        for b in batches:
            buf, offs = text_buffer(b.column("text"))
            for first, last in chunks(offs):
                cell, doc = trigram_cells(buf[offs[first] : offs[last]], offs[first : last + 1] - offs[first])
                n = np.bincount(doc, minlength=last - first)
                # without any trigram the counts come as integers
                ll = np.stack([np.bincount(doc, weights=p[cell], minlength=last - first).astype(float) for p in logp], axis=1) if len(logp) else np.zeros((last - first, 0))
                ll *= (np.minimum(n, EFFECTIVE_TRIGRAMS) / np.maximum(n, 1))[:, None]
                ll -= ll.max(axis=1, keepdims=True, initial=-np.inf) if len(logp) else 0
                r = np.exp(ll)
                r /= np.maximum(r.sum(axis=1, keepdims=True), 1e-300)
                rest = b.drop_columns(["text"]).slice(first, last - first)
                lists = [pa.array(list(x), pa.list_(pa.float64())) for x in (ll, r)]
                yield pa.RecordBatch.from_arrays([*rest.columns, *lists], names=[*rest.schema.names, "ll", "r"])

    return run


def page_text(html: Column) -> Column:
    """Visible text: without scripts, styles, comments, tags and entities."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    return F.regexp_replace(bare, r"&#?[A-Za-z0-9]+;", " ")


def address_parts(url: Column) -> dict[str, Column]:
    host = F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    return {
        "host": host,
        "domain": F.when(host.rlike(rf"\.({'|'.join(REGISTRY_LABELS)})\.[a-z]{{2}}$"), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2)),
        "suffix": F.substring_index(host, ".", -1),
        "step": F.nullif(F.lower(F.regexp_extract(url, r"^[^:]+://[^/?#]+/([A-Za-z]{2})(?:[/?#]|$)", 1)), F.lit("")),
    }


def declared_language(html: Column) -> Column:
    """Primary subtag of the lang attribute of the html element."""
    return F.nullif(F.lower(F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", 1)), F.lit(""))


def _sums(names: list[str], value: str = "r") -> list[Column]:
    return [F.sum(F.col(value)[i]).alias(f"s{i}") for i in range(len(names))]


def _array(names: list[str], suffix: str = "") -> Column:
    return F.array(*[F.col(f"s{i}{suffix}") for i in range(len(names))])


def _likelihood_table(pages: DataFrame, key: str, names: list[str], mass: list[float]) -> DataFrame:
    """log P(value | language) for each value of ``key``, add-one smoothed over its values and an unseen one."""
    n_values = pages.where(F.col(key).isNotNull()).select(key).distinct().count() + 1
    counted = pages.where(F.col(key).isNotNull()).groupBy(key).agg(*_sums(names))
    logs = [F.log((F.col(f"s{i}") + 1.0) / F.lit(m + n_values)) for i, m in enumerate(mass)]
    return materialize(counted.select(key, F.array(*logs).alias(f"ll_{key}")), key)


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(id, language, confidence, text_language, declared, suffix, host) per page."""
    names, logp = trigram_model(docs, lang_col, text_col)
    cols = address_parts(F.col(url_col)) | {"declared": declared_language(F.col(html_col))}
    rows = pages.select(F.col(id_col).alias("id"), *[c.alias(k) for k, c in cols.items()], page_text(F.coalesce(F.col(html_col), F.lit(""))).alias("text"))
    if not names:
        nothing = F.lit(None).cast("string")
        return rows.select(F.col("id").alias(id_col), nothing.alias("language"), F.lit(None).cast("double").alias("confidence"), nothing.alias("text_language"), "declared", "suffix", "host")
    schema = ", ".join([f"id {dict(rows.dtypes)['id']}", *[f"{k} string" for k in cols], "ll array<double>, r array<double>"])
    base = materialize(rows.mapInArrow(_likelihoods(pages.sparkSession.sparkContext.broadcast(logp)), schema), "pages")
    total = base.agg(F.count(F.lit(1)).alias("n"), *_sums(names)).first()
    mass = [float(total[f"s{i}"] or 0.0) for i in range(len(names))]
    size = max(1.0, sum(mass))
    overall = F.array(*[F.lit(m / size) for m in mass])

    domains = base.where("domain is not null").groupBy("domain").agg(F.count(F.lit(1)).alias("n_domain"), *_sums(names))
    domains = domains.select("domain", F.zip_with(_array(names), overall, lambda s, g: (s + DOMAIN_WEIGHT * g) / (F.col("n_domain") + DOMAIN_WEIGHT)).alias("p_domain"))
    hosts = base.where("host is not null").groupBy("host").agg(F.count(F.lit(1)).alias("n_host"), F.first("domain").alias("domain"), *_sums(names))
    hosts = hosts.withColumn("n_r", _array(names)).select("host", "domain", "n_host", "n_r").join(domains, "domain").select("host", "n_host", "n_r", "p_domain")
    # written tables: the planner knows their size, and a hot host's pages can be split in a join with them
    hosts = materialize(hosts, "hosts")
    out = base.join(hosts, "host", "left")
    for key in ("declared", "suffix", "step"):
        out = out.join(_likelihood_table(base, key, names, mass), key, "left")
    # a page's own text doesn't count in its host's prior
    of_host = F.zip_with(
        F.zip_with("n_r", "r", lambda s, r: F.greatest(s - r, F.lit(0.0))), "p_domain", lambda s, p: (s + HOST_WEIGHT * p) / (F.col("n_host") - 1 + HOST_WEIGHT)
    )
    prior = F.coalesce(of_host, overall)
    odds = F.transform(prior, lambda p: F.log(p + 1e-12))
    neutral = F.array(*[F.lit(0.0)] * len(names))
    for part in ("ll", "ll_declared", "ll_suffix", "ll_step"):
        odds = F.zip_with(odds, F.coalesce(F.col(part), neutral), lambda a, b: a + b)
    out = out.select("id", "declared", "suffix", "host", "r", odds.alias("odds"))
    best = F.array_position("odds", F.array_max("odds")).cast("int")
    exps = F.transform("odds", lambda x: F.exp(x - F.array_max("odds")))
    confidence = 1 / F.aggregate(exps, F.lit(0.0), lambda a, b: a + b)
    langs = F.array(*[F.lit(x) for x in names])
    has_text = F.array_max("r") - F.array_min("r") > 0
    return out.select(
        F.col("id").alias(id_col), F.element_at(langs, best).alias("language"), confidence.alias("confidence"),
        F.when(has_text, F.element_at(langs, F.array_position("r", F.array_max("r")).cast("int"))).alias("text_language"), "declared", "suffix", "host",
    )


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every page."""
    return identify(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/documents.parquet"))
