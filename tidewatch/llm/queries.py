"""The operators' registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import bit_sliced, inverted_multi_index, line_dedup, lm_scoring, minhash, packing, pieces, spotsigs, suffix_dedup, token_combinations, token_counts, toxicity, whitening
from tidewatch.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf: operator(table(spark, sf, "documents"))


QUERIES: dict[str, Query] = {
    "op1_minhash_dedup": _on_documents(minhash.minhash_dedup),
    "op2_suffix_dedup": _on_documents(suffix_dedup.suffix_dedup),
    "op3_pieces": _on_documents(pieces.encoded),
    "op4_neighbours": lambda spark, sf: inverted_multi_index.neighbours(table(spark, sf, "embeddings")),
    "op5_packing": _on_documents(packing.packed),
    "op6_lm_scoring": _on_documents(lm_scoring.scored),
    "op7_spotsigs": _on_documents(spotsigs.fingerprints),
    "op8_toxicity": lambda spark, sf: toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels")),
    "op9_line_dedup": _on_documents(line_dedup.line_dedup),
    "op10_token_counts": _on_documents(token_counts.token_counts),
    "op11_whitening": lambda spark, sf: whitening.whiten(table(spark, sf, "embeddings")),
    "op12_ranked_search": bit_sliced.ranked_search,
    "op13_jaccard_join": _on_documents(token_combinations.jaccard_join),
}

SQL: dict[str, str] = {
    "op9_line_dedup": line_dedup.SQL,
    "op12_ranked_search": bit_sliced.SQL,
    "op13_jaccard_join": token_combinations.SQL,
}
