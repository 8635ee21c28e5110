"""Registered queries of this package and their SQL."""

from __future__ import annotations

from .bpe_words import op7_bpe_words
from .exact_dedup import OP13_SQL, op13_exact_dedup
from .filter_audit import OP12_SQL, op12_filter_audit
from .jaccard import op9_ngram_jaccard
from .lm import op2_lm_scoring
from .order_minhash import op8_order_minhash
from .packing import op5_harmonic_packing
from .pii import op1_pii
from .quality_rules import op10_quality_rules
from .rule_ensemble import op4_quality_classifier
from .secrets import op3_secret_scan
from .toxicity import op6_toxicity
from .turn_repair import OP11_SQL, op11_turn_repair

REGISTRY = {f.__name__: f for f in (
    op1_pii, op2_lm_scoring, op3_secret_scan, op4_quality_classifier, op5_harmonic_packing, op6_toxicity, op7_bpe_words,
    op8_order_minhash, op9_ngram_jaccard, op10_quality_rules, op11_turn_repair, op12_filter_audit,
    op13_exact_dedup)}

ORACLE_SQL: dict[str, str] = {"op11_turn_repair": OP11_SQL, "op12_filter_audit": OP12_SQL, "op13_exact_dedup": OP13_SQL}
