"""The registered queries of the training-data operators, and SQL for those SQL can express."""

from __future__ import annotations

from martsmith.llm.bitfiles import op13_token_files
from martsmith.llm.decontam import OP1_SQL, op1_decontamination
from martsmith.llm.htmltext import op7_html_text
from martsmith.llm.langid import op8_language_id
from martsmith.llm.lattice import op6_lm_score
from martsmith.llm.linededup import OP9_SQL, op9_line_dedup
from martsmith.llm.packing import op2_packing
from martsmith.llm.secretscan import op5_secret_scan
from martsmith.llm.pairmaps import op11_pair_alignment
from martsmith.llm.periodic import op12_periodic_runs
from martsmith.llm.simhash import op3_simhash
from martsmith.llm.toolcalls import OP10_SQL, op10_tool_calls
from martsmith.llm.vafile import OP4_SQL, op4_topk

QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_packing": op2_packing,
    "op3_simhash": op3_simhash,
    "op4_topk": op4_topk,
    "op5_secret_scan": op5_secret_scan,
    "op6_lm_score": op6_lm_score,
    "op7_html_text": op7_html_text,
    "op8_language_id": op8_language_id,
    "op9_line_dedup": op9_line_dedup,
    "op10_tool_calls": op10_tool_calls,
    "op11_pair_alignment": op11_pair_alignment,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_token_files": op13_token_files,
}

ORACLES: dict[str, str] = {
    "op1_decontamination": OP1_SQL,
    "op4_topk": OP4_SQL,
    "op9_line_dedup": OP9_SQL,
    "op10_tool_calls": OP10_SQL,
}
