"""The registered queries of the subpackage and their DuckDB SQL (where SQL can express the result)."""

from __future__ import annotations

from tempest.llm import op8_licenses as op8
from tempest.llm import op10_chat_rotation as op10
from tempest.llm import op12_collocations as op12
from tempest.llm import op13_exact_search as op13
from tempest.llm import op4_ngram_jaccard as op4
from tempest.llm import op6_decontamination as op6
from tempest.llm import op9_quality_rules as op9
from tempest.llm.op11_alignment import op11_alignment
from tempest.llm.op1_toxicity import op1_toxicity
from tempest.llm.op2_packing import op2_packing
from tempest.llm.op3_token_counts import op3_token_counts
from tempest.llm.op5_context_mixing import op5_context_mixing
from tempest.llm.op7_quality_model import op7_quality_model

QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_packing": op2_packing,
    "op3_token_counts": op3_token_counts,
    "op4_ngram_jaccard": op4.op4_ngram_jaccard,
    "op5_context_mixing": op5_context_mixing,
    "op6_decontamination": op6.op6_decontamination,
    "op7_quality_model": op7_quality_model,
    "op8_licenses": op8.op8_licenses,
    "op9_quality_rules": op9.op9_quality_rules,
    "op10_chat_rotation": op10.op10_chat_rotation,
    "op11_alignment": op11_alignment,
    "op12_collocations": op12.op12_collocations,
    "op13_exact_search": op13.op13_exact_search,
}
ORACLE: dict[str, str] = {
    "op4_ngram_jaccard": op4.ORACLE_SQL,
    "op6_decontamination": op6.ORACLE_SQL,
    "op9_quality_rules": op9.ORACLE_SQL,
    "op10_chat_rotation": op10.ORACLE_SQL,
    "op12_collocations": op12.ORACLE_SQL,
    "op13_exact_search": op13.ORACLE_SQL,
}
