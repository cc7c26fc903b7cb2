"""Queries of this subpackage, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from taxaspark.llm.chat import op2_chat_format
from taxaspark.llm.decontam import op8_decontamination
from taxaspark.llm.langid import op10_language_id
from taxaspark.llm import chat, codes, decontam, lines, mixing, negatives, suffix, topk
from taxaspark.llm.codes import op11_vector_codes
from taxaspark.llm.lines import op12_line_dedup
from taxaspark.llm.mixing import op3_source_mix
from taxaspark.llm.negatives import op13_hard_negatives
from taxaspark.llm.quality import op9_quality
from taxaspark.llm.simhash import op5_simhash
from taxaspark.llm.suffix import op4_suffix_dedup
from taxaspark.llm.tokens import op6_token_counts
from taxaspark.llm.topk import op7_topk_search
from taxaspark.llm.toxicity import op1_toxicity


def queries() -> dict:
    return {"op1_toxicity": op1_toxicity, "op2_chat_format": op2_chat_format, "op3_source_mix": op3_source_mix, "op4_suffix_dedup": op4_suffix_dedup, "op5_simhash": op5_simhash, "op6_token_counts": op6_token_counts, "op7_topk_search": op7_topk_search, "op8_decontamination": op8_decontamination, "op9_quality": op9_quality, "op10_language_id": op10_language_id, "op11_vector_codes": op11_vector_codes, "op12_line_dedup": op12_line_dedup, "op13_hard_negatives": op13_hard_negatives}


def oracle_sql() -> dict[str, str]:
    return {"op2_chat_format": chat.ORACLE, "op3_source_mix": mixing.ORACLE, "op4_suffix_dedup": suffix.ORACLE, "op7_topk_search": topk.ORACLE, "op8_decontamination": decontam.ORACLE, "op11_vector_codes": codes.ORACLE, "op12_line_dedup": lines.ORACLE, "op13_hard_negatives": negatives.ORACLE}
