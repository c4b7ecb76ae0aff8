"""The registered queries of this package and their DuckDB SQL."""

from haulkit.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from haulkit.llm.hash_tree import OP12_SQL, op12_shards
from haulkit.llm.importance import OP13_SQL, op13_importance
from haulkit.llm.lm_scoring import op7_lm_scoring
from haulkit.llm.minhash import op9_near_dedup
from haulkit.llm.mixing import OP1_SQL, op1_mix_sources
from haulkit.llm.quality import op5_quality_rules
from haulkit.llm.sentencepiece_nbest import op3_sentencepiece
from haulkit.llm.substring_dedup import op2_substring_dedup
from haulkit.llm.suffix_dedup import op8_suffix_dedup
from haulkit.llm.token_counts import op4_token_counts
from haulkit.llm.toxicity import op6_toxicity
from haulkit.llm.whitening import op11_whitening

QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_token_counts": op4_token_counts,
    "op5_quality_rules": op5_quality_rules,
    "op6_toxicity": op6_toxicity,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_near_dedup": op9_near_dedup,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_whitening": op11_whitening,
    "op12_shards": op12_shards,
    "op13_importance": op13_importance,
}

ORACLE = {"op1_mix_sources": OP1_SQL, "op10_exact_dedup": OP10_SQL, "op12_shards": OP12_SQL, "op13_importance": OP13_SQL}
