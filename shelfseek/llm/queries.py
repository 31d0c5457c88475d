"""The registered queries of this subpackage."""

from __future__ import annotations

from shelfseek.llm import chat_events, collocations, decontaminate, hard_negatives, lm_scoring, packing, pfair, quality_trees, run_index, sharding, templates, tensor_minhash, toxicity

QUERIES = {
    "op1_decontaminate": decontaminate.op1,
    "op2_context_mixing": lm_scoring.op2,
    "op3_toxicity": toxicity.op3,
    "op4_run_index": run_index.op4,
    "op5_shard": sharding.op5,
    "op6_quality_trees": quality_trees.op6,
    "op7_chat_events": chat_events.op7,
    "op8_tensor_minhash": tensor_minhash.op8,
    "op9_site_templates": templates.op9,
    "op10_mix": pfair.op10,
    "op11_hard_negatives": hard_negatives.op11,
    "op12_collocations": collocations.op12,
    "op13_pack": packing.op13,
}
ORACLES: dict[str, str] = {
    "op11_hard_negatives": hard_negatives.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
}
