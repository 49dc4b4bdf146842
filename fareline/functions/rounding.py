"""Deterministic rounding for result comparison across engines.

``floor(x * 10^d + 0.5) / 10^d`` is made of IEEE operations that every
engine evaluates identically, unlike ``round`` (decimal HALF_UP in Spark,
binary half-away in others). It is applied twice - first at d + 3 digits to
absorb last-bit noise from a different summation order, then at d - so a
value like 20.3203125 lands on the same side in both engines. Used only at
the edge of registered queries, never inside operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

FINE_TOKENS = ("avg", "share", "rate", "speed", "duration", "pct", "delta", "ratio", "gap", "impact", "sens", "base_rev")


def digits_for(name: str) -> int:
    """2 decimals for money-like sums, 6 for averages, ratios and durations."""
    n = name.lower()
    return 6 if any(t in n for t in FINE_TOKENS) else 2


def round_doubles(df: DataFrame) -> DataFrame:
    updates = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = digits_for(f.name)
            fine, coarse = float(10 ** (d + 3)), float(10 ** d)
            pre = F.floor(F.col(f.name) * fine + 0.5) / fine
            updates[f.name] = (F.floor(pre * coarse + 0.5) / coarse).cast("double")
    return df.withColumns(updates) if updates else df


def round_sql(name: str) -> str:
    d = digits_for(name)
    fine, coarse = f"1e{d + 3}", f"1e{d}"
    pre = f"(floor({name} * {fine} + 0.5) / {fine})"
    return f"cast(floor({pre} * {coarse} + 0.5) / {coarse} as double) as {name}"
