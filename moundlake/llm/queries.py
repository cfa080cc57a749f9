"""The registered queries of this subpackage and their DuckDB SQL."""

from moundlake.llm import (
    bpe, collocations, exact_dedup, hilbert, jaccard_join, lm_scoring, mixing, pow2_packing, pq_dedup, prefix_trie, token_rollup, toxicity, warc)

QUERIES = {
    "op1_pq_near_dedup": pq_dedup.op1_pq_near_dedup,
    "op2_toxicity_ordinal": toxicity.op2_toxicity_ordinal,
    "op3_bpe_forced_boundaries": bpe.op3_bpe_forced_boundaries,
    "op4_hilbert_shards": hilbert.op4_hilbert_shards,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_temperature_mixing": mixing.op6_temperature_mixing,
    "op7_warc_segments": warc.op7_warc_segments,
    "op8_token_rollup": token_rollup.op8_token_rollup,
    "op9_cross_entropy_difference": lm_scoring.op9_cross_entropy_difference,
    "op10_exact_dedup": exact_dedup.op10_exact_dedup,
    "op11_pow2_packing": pow2_packing.op11_pow2_packing,
    "op12_collocations": collocations.op12_collocations,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLE = {
    "op1_pq_near_dedup": pq_dedup.ORACLE_OP1,
    "op5_jaccard_join": jaccard_join.ORACLE_OP5,
    "op6_temperature_mixing": mixing.ORACLE_OP6,
    "op7_warc_segments": warc.ORACLE_OP7,
    "op8_token_rollup": token_rollup.ORACLE_OP8,
    "op9_cross_entropy_difference": lm_scoring.ORACLE_OP9,
    "op10_exact_dedup": exact_dedup.ORACLE_OP10,
    "op12_collocations": collocations.ORACLE_OP12,
    "op13_prefix_trie": prefix_trie.ORACLE_OP13,
}
