"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from textmill.llm.audit import OP12_SQL, op12_filter_audit
from textmill.llm.counts import OP8_SQL, op8_token_rollup
from textmill.llm.decontaminate import OP1_SQL, op1_decontaminate
from textmill.llm.licences import OP2_SQL, op2_licences
from textmill.llm.packing import op7_pack_best_fit
from textmill.llm.quality import op9_quality_neighbours
from textmill.llm.simhash import op10_simhash_near_dedup
from textmill.llm.spelling import OP11_SQL, op11_spelling_variants
from textmill.llm.token_files import op13_token_files
from textmill.llm.topk import OP5_SQL, op5_exact_top_k
from textmill.llm.toxicity import op4_toxicity
from textmill.llm.urls import OP6_SQL, op6_url_rules
from textmill.llm.warc import op3_warc_round_trip

QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_licences": op2_licences,
    "op3_warc_round_trip": op3_warc_round_trip,
    "op4_toxicity": op4_toxicity,
    "op5_exact_top_k": op5_exact_top_k,
    "op6_url_rules": op6_url_rules,
    "op7_pack_best_fit": op7_pack_best_fit,
    "op8_token_rollup": op8_token_rollup,
    "op9_quality_neighbours": op9_quality_neighbours,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_files": op13_token_files,
}

# The others have no SQL form: archives, learned scores, tokenizers, fingerprints.
ORACLE: dict[str, str] = {
    "op1_decontaminate": OP1_SQL,
    "op2_licences": OP2_SQL,
    "op5_exact_top_k": OP5_SQL,
    "op6_url_rules": OP6_SQL,
    "op8_token_rollup": OP8_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
}
