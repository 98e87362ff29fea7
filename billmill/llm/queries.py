"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from billmill.llm import op1_jaccard_join as op1
from billmill.llm import op3_suffix_dedup as op3
from billmill.llm import op5_decontaminate as op5
from billmill.llm import op9_quality as op9
from billmill.llm import op11_collocations as op11
from billmill.llm import op12_source_audit as op12
from billmill.llm import op13_exact_dedup as op13
from billmill.llm.op2_lm_score import op2_lm_score
from billmill.llm.op4_token_counts import op4_token_counts
from billmill.llm.op6_toxicity import op6_toxicity
from billmill.llm.op7_bpe import op7_bpe
from billmill.llm.op8_packed_ids import op8_packed_ids
from billmill.llm.op10_secrets import op10_secrets
from billmill.llm.ship import shipped

_ALL = (
    op1.op1_jaccard_join,
    op2_lm_score,
    op3.op3_suffix_dedup,
    op4_token_counts,
    op5.op5_decontaminate,
    op6_toxicity,
    op7_bpe,
    op8_packed_ids,
    op9.op9_quality_rules,
    op10_secrets,
    op11.op11_collocations,
    op12.op12_source_audit,
    op13.op13_exact_dedup,
)
QUERIES = {query.__name__: shipped(query) for query in _ALL}

# The other operators go beyond SQL; tests compare them with direct computations and libraries.
ORACLE_SQL: dict[str, str] = {
    "op1_jaccard_join": op1.SQL,
    "op3_suffix_dedup": op3.SQL,
    "op5_decontaminate": op5.SQL,
    "op9_quality_rules": op9.SQL,
    "op11_collocations": op11.SQL,
    "op12_source_audit": op12.SQL,
    "op13_exact_dedup": op13.SQL,
}
