"""The queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .attribution import op9_token_attribution
from .chat import op5_chat_windows
from .contamination import op7_benchmark_contamination
from .exact_dedup import OP12_SQL, op12_exact_dedup
from .fuzzy_passages import op10_fuzzy_passages
from .jaccard_join import op1_ngram_jaccard_join
from .language import op8_language_id
from .merkle import OP11_SQL, op11_merkle_manifest
from .mixing import OP2_SQL, op2_mixing_curriculum
from .periodic import op13_periodic_runs
from .quality import op3_quality_outliers
from .secrets import op4_secret_scan
from .suffix_dedup import op6_suffix_dedup


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
        "op2_mixing_curriculum": op2_mixing_curriculum,
        "op3_quality_outliers": op3_quality_outliers,
        "op4_secret_scan": op4_secret_scan,
        "op5_chat_windows": op5_chat_windows,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_benchmark_contamination": op7_benchmark_contamination,
        "op8_language_id": op8_language_id,
        "op9_token_attribution": op9_token_attribution,
        "op10_fuzzy_passages": op10_fuzzy_passages,
        "op11_merkle_manifest": op11_merkle_manifest,
        "op12_exact_dedup": op12_exact_dedup,
        "op13_periodic_runs": op13_periodic_runs,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing_curriculum": OP2_SQL, "op11_merkle_manifest": OP11_SQL, "op12_exact_dedup": OP12_SQL}
