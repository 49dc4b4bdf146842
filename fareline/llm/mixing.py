"""Mixing sources to target weights, with DataFrame and SQL functions alone.

Temperature mixing: a source's weight is its token share to the power ``alpha``,
normalised. ``alpha`` runs from 1 (as the corpus is) to 0 (all sources alike); it is
bisected to the flattest mixture that keeps a repetition limit, or to the mixture that
meets a target entropy. Each round evaluates a grid of exponents in one grouped
aggregate over the table of sources and keeps one cell of the grid.

A weight and the token budget give a source its epochs: whole passes, and a part of one.
A source's documents are dealt into blocks by a hash. Every epoch is a permutation of
the blocks and of the documents within (hashes with the epoch); the last, partial epoch
takes blocks in its order up to the budget and, in the block where the budget ends,
documents in its order. The document in which the budget ends is taken, so a source
overshoots its tokens by less than one document. A source has as many blocks as blocks
have documents, the square root of its documents, so no window runs over a whole source.

Rows come out as (document, epoch) with ``slot`` in [0, 1): ordering by it spreads every
source evenly over the mixture.

Defined results: documents without tokens (null, empty or blank texts) are left out;
a null source is a source; repeated rows are documents of their own but share their
places; without tokens the result is empty; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from fareline.llm.common import materialize

REPETITION = 1.25
GRID, ROUNDS = 32, 8
SEED = 17


def token_count(text: Column) -> Column:
    """White-space separated words of a text; null counts as empty."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+", " "))
    return F.when(t == "", F.lit(0)).otherwise(F.length(t) - F.length(F.replace(t, F.lit(" "), F.lit(""))) + 1).cast("long")


def hash_unit(*parts: Column) -> Column:
    """A number in [0, 1) from the MD5 digest of the parts (52 bits, so exact in any engine)."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(1 << 52))


def _evaluate(sources: DataFrame, whole: int, low: float, high: float, budget: float) -> list:
    """For a grid of exponents, in order: the entropy and the largest repetition of the mixture."""
    grid = sources.select("tokens", F.explode(F.sequence(F.lit(0), F.lit(GRID))).alias("i"))
    alpha = F.lit(low) + F.col("i") * F.lit((high - low) / GRID)
    share = F.log(F.col("tokens") / F.lit(float(whole)))
    grid = grid.select("i", alpha.alias("alpha"), "tokens", share.alias("lp")).withColumn("w", F.exp(F.col("alpha") * F.col("lp")))
    sums = grid.groupBy("i", "alpha").agg(F.sum("w").alias("z"), F.sum(F.col("w") * F.col("lp")).alias("wl"), F.max(F.col("w") / F.col("tokens")).alias("top"))
    out = sums.select(
        "i", "alpha", (F.log("z") - F.col("alpha") * F.col("wl") / F.col("z")).alias("entropy"), (F.col("top") / F.col("z") * F.lit(budget)).alias("repetition")
    )
    return out.orderBy("i").collect()  # GRID + 1 rows


def find_exponent(sources: DataFrame, whole: int, budget: float, entropy: float | None = None, repetition: float = REPETITION) -> float:
    """The smallest exponent in [0, 1] within the limit; 1 if even that isn't within it.

    With a target ``entropy`` the limit is that the mixture's entropy is at most the target.
    Either limit holds from some exponent on: a larger one makes the mixture less even.
    """
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        rows = _evaluate(sources, whole, low, high, budget)
        ok = [r.entropy <= entropy if entropy is not None else r.repetition <= repetition for r in rows]
        first = ok.index(True) if any(ok) else None
        if first is None or first == 0:
            return high if first is None else low
        step = (high - low) / GRID
        low, high = low + (first - 1) * step, low + first * step
    return high


def mix(
    docs: DataFrame,
    budget: float | None = None,
    entropy: float | None = None,
    repetition: float = REPETITION,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    seed: int = SEED,
) -> DataFrame:
    """(id, source, tokens, epoch, block, slot) of the mixture; ``budget`` in tokens (default: as many as there are)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), token_count(F.col(text_col)).alias("tokens")).where("tokens > 0")
    rows = materialize(rows, "mix-docs")
    sources = materialize(rows.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")), "sources")
    whole = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = float(whole if budget is None else budget)
    alpha = find_exponent(sources, whole, budget, entropy, repetition) if whole else 1.0
    powers = sources.withColumn("w", F.exp(F.lit(alpha) * F.log(F.col("tokens") / F.lit(float(max(whole, 1))))))
    z = powers.agg(F.sum("w")).first()[0] or 1.0
    # the budget of a source in whole tokens; its epochs and the tokens of the partial one
    plan = (
        powers.withColumn("weight", F.col("w") / F.lit(z))
        .withColumn("quota", F.floor(F.col("weight") * F.lit(budget) + F.lit(0.5)).cast("long"))
        .select(
            "source", "docs", "tokens", "weight", "quota",
            F.expr("quota div tokens").alias("epochs"), (F.col("quota") % F.col("tokens")).alias("part"),
            F.ceil(F.sqrt(F.col("docs").cast("double"))).cast("long").alias("blocks"),
        )
    )
    plan = materialize(plan, "plan")
    name = F.coalesce(F.col("source"), F.lit("\u0000")).alias("key")
    shares = plan.select(name, F.col("tokens").alias("whole"), "epochs", "part", "blocks", (F.col("quota") / F.col("tokens")).alias("passes"))
    placed = rows.select("id", "source", "tokens", name).join(shares.select("key", "blocks"), "key")
    place = F.floor(hash_unit(F.lit(str(seed)), F.col("id").cast("string")) * F.col("blocks")).cast("long")
    placed = materialize(placed.select("key", "id", "source", "tokens", place.alias("block")), "blocks")
    # every epoch's order of blocks, with the tokens before each; the partial epoch stops at its part
    last = F.when(F.col("part") > 0, F.col("epochs")).otherwise(F.col("epochs") - 1)
    blocks = placed.groupBy("key", "block").agg(F.sum("tokens").alias("sum"), F.first("source").alias("source")).join(shares.drop("blocks"), "key")
    blocks = blocks.where(last >= 0).withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    blocks = blocks.withColumn("place", hash_unit(F.lit(f"{seed}:block"), F.col("epoch").cast("string"), F.col("block").cast("string"), F.col("source")))
    in_order = Window.partitionBy("key", "epoch").orderBy("place", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("sum").over(in_order), F.lit(0)))
    ends = (F.col("epoch") == F.col("epochs")) & (F.col("before") + F.col("sum") > F.col("part"))
    blocks = blocks.where((F.col("epoch") < F.col("epochs")) | (F.col("before") < F.col("part"))).withColumn("ends", ends)
    blocks = materialize(blocks.select("key", "block", "epoch", "before", "sum", "whole", "part", "passes", "ends"), "order")
    taken = placed.join(blocks, ["key", "block"]).withColumn("spot", hash_unit(F.lit(f"{seed}:doc"), F.col("epoch").cast("string"), F.col("id").cast("string")))
    up_to = Window.partitionBy("key", "block").orderBy("spot", "id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    cut = taken.where("ends").withColumn("run", F.col("before") + F.coalesce(F.sum("tokens").over(up_to), F.lit(0))).where("run < part").drop("run")
    slot = (F.col("epoch") + (F.col("before") + F.col("spot") * F.col("sum")) / F.col("whole")) / F.col("passes")
    return taken.where("not ends").unionByName(cut).select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "tokens", "epoch", "block", F.least(slot, F.lit(1.0 - 1e-12)).alias("slot")
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to as many tokens as there are, no source more than REPETITION times."""
    return mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP5_SQL = f"""
WITH RECURSIVE t AS (
    SELECT doc_id, source, trim(regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+', ' ', 'g')) AS t FROM documents
), d AS (
    SELECT doc_id, source, (length(t) - length(replace(t, ' ', '')) + 1)::BIGINT AS tokens FROM t WHERE t <> ''
), s AS (
    SELECT source, sum(tokens)::BIGINT AS tokens, count(*) AS docs FROM d GROUP BY source
), w AS (
    SELECT sum(tokens)::BIGINT AS whole FROM s
), bisect(round, low, high) AS (
    SELECT 0, 0.0::DOUBLE, 1.0::DOUBLE
    UNION ALL
    SELECT round + 1,
        CASE WHEN first IS NULL THEN high WHEN first = 0 THEN low ELSE low + (first - 1) * ((high - low) / {GRID}) END,
        CASE WHEN first IS NULL THEN high WHEN first = 0 THEN low ELSE low + first * ((high - low) / {GRID}) END
    FROM (
        SELECT round, low, high, min(i) FILTER (WHERE repetition <= {REPETITION}) AS first
        FROM (
            SELECT round, low, high, i, max(w / tokens) / sum(w) * whole AS repetition
            FROM (
                SELECT round, low, high, g.i, tokens, whole, exp((low + g.i * ((high - low) / {GRID})) * ln(tokens / whole::DOUBLE)) AS w
                FROM bisect, range({GRID + 1}) AS g(i), s, w WHERE round < {ROUNDS}
            ) GROUP BY round, low, high, i, whole
        ) GROUP BY round, low, high
    )
), a AS (
    SELECT high AS alpha FROM bisect ORDER BY round DESC LIMIT 1
), p AS (
    SELECT source, tokens, docs, exp(alpha * ln(tokens / whole::DOUBLE)) AS w, whole FROM s, w, a
), q AS (
    SELECT source, tokens, floor(w / sum(w) OVER () * whole + 0.5)::BIGINT AS quota, ceil(sqrt(docs::DOUBLE))::BIGINT AS blocks FROM p
), placed AS (
    SELECT d.doc_id, d.source, d.tokens, quota // q.tokens AS epochs, quota % q.tokens AS part, quota / q.tokens::DOUBLE AS passes, q.tokens AS whole,
        floor(('0x' || substr(md5(concat_ws(':', '{SEED}', d.doc_id)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE * blocks)::BIGINT AS block
    FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source
), sums AS (
    SELECT source, block, any_value(epochs) AS epochs, any_value(part) AS part, any_value(passes) AS passes, any_value(whole) AS whole, sum(tokens)::BIGINT AS total
    FROM placed GROUP BY source, block
), turns AS (
    SELECT *, unnest(range(epochs + (part > 0)::INT)) AS epoch FROM sums
), spots AS (
    SELECT *, ('0x' || substr(md5(concat_ws(':', '{SEED}:block', epoch, block, source)), 1, 13))::BIGINT AS place FROM turns
), befores AS (
    SELECT *, coalesce(sum(total) OVER (PARTITION BY source, epoch ORDER BY place, block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS b FROM spots
), taken AS (
    SELECT p.doc_id, p.source, p.tokens, p.block, b.epoch, b.b, b.total, b.whole, b.part, b.passes, b.epoch = b.epochs AND b.b + b.total > b.part AS ends,
        ('0x' || substr(md5(concat_ws(':', '{SEED}:doc', b.epoch, p.doc_id)), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS spot
    FROM placed p JOIN befores b ON p.block = b.block AND p.source IS NOT DISTINCT FROM b.source
    WHERE b.epoch < b.epochs OR b.b < b.part
), run AS (
    SELECT *, b + coalesce(sum(tokens) OVER (PARTITION BY source, block, epoch, ends ORDER BY spot, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS r
    FROM taken
)
SELECT doc_id, source, tokens, epoch, block, least((epoch + (b + spot * total) / whole) / passes, 1.0::DOUBLE - 1e-12::DOUBLE) AS slot
FROM run WHERE NOT ends OR r < part
"""
