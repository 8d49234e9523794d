"""The queries of this subpackage and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from .collocations import OP12_SQL, op12_phrase_collocations
from .html_blocks import op9_html_extraction
from .licenses import OP4_SQL, op4_license_scan
from .line_runs import OP11_SQL, op11_line_dedup
from .mixing import op3_mix_sources
from .ngram_join import OP1_SQL, op1_ngram_jaccard_join
from .pieces import op5_sentencepiece
from .quality_pu import op6_quality_classifier
from .quality_rules import OP8_SQL, op8_quality_rules
from .repair import OP13_SQL, op13_conversation_repair
from .rp_forest import OP10_SQL, op10_embedding_near_dup
from .toxicity import op7_toxicity
from .url_templates import OP2_SQL, op2_url_filters

QUERIES = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_url_filters": op2_url_filters,
    "op3_mix_sources": op3_mix_sources,
    "op4_license_scan": op4_license_scan,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_toxicity": op7_toxicity,
    "op8_quality_rules": op8_quality_rules,
    "op9_html_extraction": op9_html_extraction,
    "op10_embedding_near_dup": op10_embedding_near_dup,
    "op11_line_dedup": op11_line_dedup,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE = {
    "op1_ngram_jaccard_join": OP1_SQL,
    "op2_url_filters": OP2_SQL,
    "op4_license_scan": OP4_SQL,
    "op8_quality_rules": OP8_SQL,
    "op10_embedding_near_dup": OP10_SQL,
    "op11_line_dedup": OP11_SQL,
    "op12_phrase_collocations": OP12_SQL,
    "op13_conversation_repair": OP13_SQL,
}
