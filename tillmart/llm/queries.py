"""The operators as named queries over the given tables, with SQL where SQL can say it."""

from __future__ import annotations

from . import (
    alignment, binary, decontaminate, maxent, neardup, packing, private, secrets, sharding, topk,
    toxicity, urls, whitening,
)

QUERIES = {
    "op1_exact_topk": topk.op1_exact_topk,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_secrets": secrets.op3_secrets,
    "op4_packing": packing.op4_packing,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_sharding": sharding.op6_sharding,
    "op7_near_duplicates": neardup.op7_near_duplicates,
    "op8_token_blocks": binary.op8_token_blocks,
    "op9_url_filter": urls.op9_url_filter,
    "op10_private": private.op10_private,
    "op11_whitening": whitening.op11_whitening,
    "op12_alignment": alignment.op12_alignment,
    "op13_lm_scoring": maxent.op13_lm_scoring,
}

ORACLES = {"op1_exact_topk": topk.OP1_SQL}
