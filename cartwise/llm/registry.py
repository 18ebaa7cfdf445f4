"""The queries of the numbered operators, and the SQL of those that have one."""

from __future__ import annotations

from cartwise.llm import op3_decontaminate, op5_search, op7_jaccard_join, op8_tool_calls, op9_url_filter, op11_near_vectors, op12_codes, op13_resample
from cartwise.llm.op1_quality import op1_quality
from cartwise.llm.op2_main_text import op2_main_text
from cartwise.llm.op4_bpe import op4_bpe
from cartwise.llm.op6_language import op6_language
from cartwise.llm.op10_token_counts import op10_token_counts

QUERIES = {
    "op1_quality": op1_quality,
    "op2_main_text": op2_main_text,
    "op3_decontaminate": op3_decontaminate.op3_decontaminate,
    "op4_bpe": op4_bpe,
    "op5_search": op5_search.op5_search,
    "op6_language": op6_language,
    "op7_jaccard_join": op7_jaccard_join.op7_jaccard_join,
    "op8_tool_calls": op8_tool_calls.op8_tool_calls,
    "op9_url_filter": op9_url_filter.op9_url_filter,
    "op10_token_counts": op10_token_counts,
    "op11_near_vectors": op11_near_vectors.op11_near_vectors,
    "op12_codes": op12_codes.op12_codes,
    "op13_resample": op13_resample.op13_resample,
}
#: The others are tested against brute force, a reference library or held-out labels.
ORACLE = {
    "op3_decontaminate": op3_decontaminate.SQL,
    "op5_search": op5_search.SQL,
    "op7_jaccard_join": op7_jaccard_join.SQL,
    "op8_tool_calls": op8_tool_calls.SQL,
    "op9_url_filter": op9_url_filter.SQL,
    "op11_near_vectors": op11_near_vectors.SQL,
    "op12_codes": op12_codes.SQL,
    "op13_resample": op13_resample.SQL,
}
