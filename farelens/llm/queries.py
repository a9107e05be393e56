"""The registered corpus queries and the SQL of those that SQL can express."""

from __future__ import annotations

from .bpe import op5_bpe_encode
from .exact_dedup import OP10_SQL, op10_exact_dedup
from .jaccard_join import op3_jaccard_join
from .license_join import op6_license_scan
from .lm_scoring import op2_lm_scoring
from .pii import op1_pii
from .prefix_trie import OP12_SQL, op12_prefix_trie
from .rule_ensemble import op9_quality
from .spelling import OP11_SQL, op11_spelling_variants
from .substring_dedup import op8_substring_dedup
from .suffix_match import op4_decontamination
from .toxicity import op7_toxicity
from .url_filter import OP13_SQL, op13_url_filter

QUERIES = {
    "op1_pii": op1_pii,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontamination": op4_decontamination,
    "op5_bpe_encode": op5_bpe_encode,
    "op6_license_scan": op6_license_scan,
    "op7_toxicity": op7_toxicity,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_quality": op9_quality,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_url_filter": op13_url_filter,
}
ORACLES = {
    "op10_exact_dedup": OP10_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_prefix_trie": OP12_SQL,
    "op13_url_filter": OP13_SQL,
}
