"""The numbered queries and the SQL of those that SQL can express."""

from __future__ import annotations

from tamis.llm.decontaminate import op6_decontaminate
from tamis.llm.language_id import op10_language_id
from tamis.llm.licenses import op7_license_scan
from tamis.llm.line_rules import op3_line_rules
from tamis.llm.mixing import op8_mix_sources
from tamis.llm.near_duplicates import op9_near_duplicates
from tamis.llm.ngram_lm import op2_ngram_scores
from tamis.llm.oracles import ORACLE_SQL as ORACLE_SQL
from tamis.llm.phrases import op11_phrases
from tamis.llm.pii import op1_personal_data
from tamis.llm.prefix_trie import op12_conversation_trie
from tamis.llm.token_ids import op5_token_shards
from tamis.llm.toxicity import op4_toxicity
from tamis.llm.url_rules import op13_url_rules

QUERIES = {
    q.__name__: q
    for q in (
        op1_personal_data, op2_ngram_scores, op3_line_rules, op4_toxicity, op5_token_shards, op6_decontaminate, op7_license_scan, op8_mix_sources, op9_near_duplicates, op10_language_id,
        op11_phrases, op12_conversation_trie, op13_url_rules,
    )
}
