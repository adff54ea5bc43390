"""Queries of this subpackage and their DuckDB SQL, for __spark_entry__."""

from __future__ import annotations

from . import exact_dedup, mixing, near_dedup, substring_dedup
from .bpe import op2_bpe
from .exact_dedup import op4_exact_dedup
from .language_id import op7_language_id
from .lm_score import op9_lm_score
from .mixing import op6_mixing
from .near_dedup import op1_near_dedup
from .quality import op8_quality
from .substring_dedup import op5_substring_dedup
from .token_counts import op10_token_counts
from .toxicity import op3_toxicity

QUERIES = {
    "op1_near_dedup": op1_near_dedup,
    "op2_bpe": op2_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_mixing": op6_mixing,
    "op7_language_id": op7_language_id,
    "op8_quality": op8_quality,
    "op9_lm_score": op9_lm_score,
    "op10_token_counts": op10_token_counts,
}

ORACLES = {
    "op1_near_dedup": near_dedup.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op5_substring_dedup": substring_dedup.ORACLE,
    "op6_mixing": mixing.ORACLE,
}
