"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from wellspring.llm.byte_bpe import op13_byte_bpe
from wellspring.llm.chat import op4_chat_format
from wellspring.llm.hnsw import op6_nearest_neighbours
from wellspring.llm.importance import OP12_SQL, op12_importance_resampling
from wellspring.llm.merkle import op11_merkle_manifest
from wellspring.llm.mixing import op2_mix_sources
from wellspring.llm.pieces import op3_sentencepiece
from wellspring.llm.quality import op8_quality_classifier
from wellspring.llm.repetition import op10_quality_rules
from wellspring.llm.simhash import op7_simhash_near_dedup
from wellspring.llm.substring import op1_substring_dedup
from wellspring.llm.token_files import op9_token_files
from wellspring.llm.toxicity import op5_toxicity

QUERIES = {f.__name__: f for f in (
    op1_substring_dedup, op2_mix_sources, op3_sentencepiece, op4_chat_format, op5_toxicity, op6_nearest_neighbours,
    op7_simhash_near_dedup, op8_quality_classifier, op9_token_files, op10_quality_rules, op11_merkle_manifest,
    op12_importance_resampling, op13_byte_bpe)}
ORACLE: dict[str, str] = {"op12_importance_resampling": OP12_SQL}
