"""The training-data operators' queries, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from graphmill.llm.bitpack import op9_bit_packed_ids
from graphmill.llm.crosstok import op12_cross_tokens
from graphmill.llm.extract import op10_wrapper_induction
from graphmill.llm.jaccard import op7_jaccard_join
from graphmill.llm.langid import op13_language_id
from graphmill.llm.lm import op3_interpolated_lm
from graphmill.llm.mixing import op8_mix_sources
from graphmill.llm.neardup import op1_embedding_neardup
from graphmill.llm.packing import op4_packing
from graphmill.llm.periodic import op11_periodic_runs
from graphmill.llm.simhash import op6_simhash
from graphmill.llm.substring import op2_substring_dedup
from graphmill.llm.toxicity import op5_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_embedding_neardup,
        op2_substring_dedup,
        op3_interpolated_lm,
        op4_packing,
        op5_toxicity,
        op6_simhash,
        op7_jaccard_join,
        op8_mix_sources,
        op9_bit_packed_ids,
        op10_wrapper_induction,
        op11_periodic_runs,
        op12_cross_tokens,
        op13_language_id,
    )
}

ORACLE: dict[str, str] = {}
