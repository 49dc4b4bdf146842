"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

import functools
from pathlib import Path

from fareline.llm.decontaminate import OP3_SQL, op3_decontaminate
from fareline.llm.jaccard_join import OP8_SQL, op8_jaccard_join
from fareline.llm.language_id import op1_language_id
from fareline.llm.lm_scoring import op9_lm_scoring
from fareline.llm.minhash_dedup import OP12_SQL, op12_minhash_dedup
from fareline.llm.mixing import OP5_SQL, op5_mixing
from fareline.llm.mtree_search import OP4_SQL, op4_mtree_search
from fareline.llm.pii import op6_pii
from fareline.llm.quality_classifier import op10_quality_classifier
from fareline.llm.ranked_search import OP11_SQL, op11_ranked_search
from fareline.llm.suffix_dedup import OP2_SQL, op2_suffix_dedup
from fareline.llm.token_counts import op7_token_counts
from fareline.llm.whitening import op13_whitening

ROOT = str(Path(__file__).resolve().parents[2])


def with_package(query):
    """Lets the session's Python workers import this package from where the driver has it."""

    @functools.wraps(query)
    def run(spark, sf_dir):
        paths = spark.sparkContext.environment.get("PYTHONPATH", "")
        if ROOT not in paths.split(":"):
            spark.sparkContext.environment["PYTHONPATH"] = f"{ROOT}:{paths}".rstrip(":")
        return query(spark, sf_dir)

    return run


QUERIES = {
    f.__name__: with_package(f)
    for f in (
        op1_language_id,
        op2_suffix_dedup,
        op3_decontaminate,
        op4_mtree_search,
        op5_mixing,
        op6_pii,
        op7_token_counts,
        op8_jaccard_join,
        op9_lm_scoring,
        op10_quality_classifier,
        op11_ranked_search,
        op12_minhash_dedup,
        op13_whitening,
    )
}
# the rest learn a model (1, 6, 9, 10), need a tokenizer (7) or eigenvectors (13)
ORACLE_SQL: dict[str, str] = {
    "op2_suffix_dedup": OP2_SQL,
    "op3_decontaminate": OP3_SQL,
    "op4_mtree_search": OP4_SQL,
    "op5_mixing": OP5_SQL,
    "op8_jaccard_join": OP8_SQL,
    "op11_ranked_search": OP11_SQL,
    "op12_minhash_dedup": OP12_SQL,
}
