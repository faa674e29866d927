"""The queries of this subpackage and, where SQL can express them, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ranktide.llm.bpe import op5_byte_bpe
from ranktide.llm.contamination import ORACLE_SQL as CONTAMINATION_SQL
from ranktide.llm.contamination import op1_decontamination
from ranktide.llm.conversations import op13_conversation_repair
from ranktide.llm.jaccard import ORACLE_SQL as JACCARD_SQL
from ranktide.llm.jaccard import op3_jaccard_join
from ranktide.llm.language import op4_language_id
from ranktide.llm.maintext import op6_main_text
from ranktide.llm.paragraphs import op2_substring_dedup
from ranktide.llm.quality import op9_weak_supervision
from ranktide.llm.spelling import op11_spelling_variants
from ranktide.llm.substrings import op7_suffix_dedup
from ranktide.llm.tokencounts import op12_token_counts
from ranktide.llm.tokenfile import op10_token_files
from ranktide.llm.toxicity import op8_toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_language_id": op4_language_id,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_main_text": op6_main_text,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_toxicity": op8_toxicity,
    "op9_weak_supervision": op9_weak_supervision,
    "op10_token_files": op10_token_files,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_token_counts": op12_token_counts,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op1_decontamination": CONTAMINATION_SQL,
    "op3_jaccard_join": JACCARD_SQL,
}
