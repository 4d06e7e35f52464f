"""The corpus operators' queries and, where SQL can express them, their oracle SQL."""

from __future__ import annotations

from tactus.llm.decontamination import OP7_SQL, op7_decontamination
from tactus.llm.divergence import OP13_SQL, op13_source_divergence
from tactus.llm.fingerprints import op10_document_fingerprints
from tactus.llm.hard_negatives import OP12_SQL, op12_hard_negatives
from tactus.llm.jaccard_join import op1_jaccard_join
from tactus.llm.language_id import op2_language_id
from tactus.llm.line_dedup import OP6_SQL, op6_line_dedup
from tactus.llm.packing import op8_packing
from tactus.llm.pii import op9_pii
from tactus.llm.sentencepieces import op11_sentencepiece
from tactus.llm.substring_dedup import op3_substring_dedup
from tactus.llm.token_files import op5_token_files
from tactus.llm.toxicity import op4_toxicity

QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_language_id": op2_language_id,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_token_files": op5_token_files,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_packing": op8_packing,
    "op9_pii": op9_pii,
    "op10_document_fingerprints": op10_document_fingerprints,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_source_divergence": op13_source_divergence,
}

ORACLE_SQL: dict[str, str] = {
    "op6_line_dedup": OP6_SQL,
    "op7_decontamination": OP7_SQL,
    "op12_hard_negatives": OP12_SQL,
    "op13_source_divergence": OP13_SQL,
}
