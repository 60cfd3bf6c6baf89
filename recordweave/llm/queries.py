"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from recordweave.llm import decontamination, filter_audit, lexical_search, url_filters, warc
from recordweave.llm.decontamination import op10_decontamination
from recordweave.llm.embedding_dedup import op8_embedding_dedup
from recordweave.llm.filter_audit import op13_filter_audit
from recordweave.llm.html_extraction import op6_html_extraction
from recordweave.llm.lexical_search import op11_lexical_search
from recordweave.llm.lm_scoring import op9_lm_scoring
from recordweave.llm.ngram_join import op3_ngram_jaccard_join
from recordweave.llm.packing import op12_best_fit_packing
from recordweave.llm.quality import op4_quality_classifier
from recordweave.llm.sentencepiece import op1_sentencepiece
from recordweave.llm.toxicity import op5_toxicity
from recordweave.llm.url_filters import op2_url_filters
from recordweave.llm.warc import op7_warc

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_url_filters": op2_url_filters,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_toxicity": op5_toxicity,
    "op6_html_extraction": op6_html_extraction,
    "op7_warc": op7_warc,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_decontamination": op10_decontamination,
    "op11_lexical_search": op11_lexical_search,
    "op12_best_fit_packing": op12_best_fit_packing,
    "op13_filter_audit": op13_filter_audit,
}
ORACLE_SQL = {"op2_url_filters": url_filters.SQL, "op7_warc": warc.SQL, "op10_decontamination": decontamination.SQL, "op11_lexical_search": lexical_search.SQL, "op13_filter_audit": filter_audit.SQL}
