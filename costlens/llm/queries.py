"""The queries that the entry file registers for this subpackage, and their SQL."""

from __future__ import annotations

from .chat import op10_chat_formatting
from .decontamination import op5_decontamination
from .language_model import op8_lm_scoring
from .line_dedup import op1_line_dedup
from .merkle import op11_merkle_manifest
from .oracles import ORACLE_SQL as ORACLE_SQL
from .packing import op6_packing
from .prefix_trie import op13_prefix_trie
from .quality import op4_quality_rules
from .simhash import op7_simhash
from .suffix_dedup import op2_suffix_dedup
from .token_counts import op3_token_counts
from .token_output import op9_token_output
from .toxicity import op12_toxicity

QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_quality_rules": op4_quality_rules,
    "op5_decontamination": op5_decontamination,
    "op6_packing": op6_packing,
    "op7_simhash": op7_simhash,
    "op8_lm_scoring": op8_lm_scoring,
    "op9_token_output": op9_token_output,
    "op10_chat_formatting": op10_chat_formatting,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_toxicity": op12_toxicity,
    "op13_prefix_trie": op13_prefix_trie,
}
