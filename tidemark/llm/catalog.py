"""Registered queries of the operators, and their SQL where there is one."""

from __future__ import annotations

from tidemark.llm import (
    chat_format, conversation_repair, jaccard_join, line_dedup, periodic_runs,
)
from tidemark.llm.chat_format import op7_chat_format
from tidemark.llm.conversation_repair import op13_conversation_repair
from tidemark.llm.decontamination import op5_decontamination
from tidemark.llm.fingerprints import op8_fingerprints
from tidemark.llm.jaccard_join import op4_jaccard_join
from tidemark.llm.language_id import op11_language_id
from tidemark.llm.language_model import op6_lm_scoring
from tidemark.llm.line_dedup import op10_line_dedup
from tidemark.llm.packing import op2_best_fit_packing
from tidemark.llm.periodic_runs import op12_periodic_runs
from tidemark.llm.quality import op9_quality_classifier
from tidemark.llm.secret_scan import op1_secret_scan
from tidemark.llm.suffix_dedup import op3_suffix_dedup

QUERIES = {
    query.__name__: query
    for query in (
        op1_secret_scan, op2_best_fit_packing, op3_suffix_dedup, op4_jaccard_join,
        op5_decontamination, op6_lm_scoring, op7_chat_format, op8_fingerprints,
        op9_quality_classifier, op10_line_dedup, op11_language_id,
        op12_periodic_runs, op13_conversation_repair,
    )
}

ORACLES = {
    "op4_jaccard_join": jaccard_join.ORACLE_SQL,
    "op7_chat_format": chat_format.ORACLE_SQL,
    "op10_line_dedup": line_dedup.ORACLE_SQL,
    "op12_periodic_runs": periodic_runs.ORACLE_SQL,
    "op13_conversation_repair": conversation_repair.ORACLE_SQL,
}
