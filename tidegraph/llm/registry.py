"""The corpus queries by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidegraph.llm.bpe import op2_bpe_round_trip
from tidegraph.llm.jaccard_join import op3_jaccard_join
from tidegraph.llm.language_id import op1_language_id
from tidegraph.llm.language_model import op10_lm_scoring
from tidegraph.llm.packing import op8_packing
from tidegraph.llm.pii import op7_pii
from tidegraph.llm.quality import op9_quality_rules
from tidegraph.llm.sharding import op4_sharding
from tidegraph.llm.token_store import op5_token_store
from tidegraph.llm.topk import op6_exact_top_k


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_bpe_round_trip": op2_bpe_round_trip,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_sharding": op4_sharding,
        "op5_token_store": op5_token_store,
        "op6_exact_top_k": op6_exact_top_k,
        "op7_pii": op7_pii,
        "op8_packing": op8_packing,
        "op9_quality_rules": op9_quality_rules,
        "op10_lm_scoring": op10_lm_scoring,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {}
