"""The queries of this package, and the same as SQL where SQL can express them."""

from __future__ import annotations

import corpus_pipeline
from brooklet.llm.chat_format import OP4_SQL, op4_chat_formatting
from brooklet.llm.decontaminate import op6_benchmark_decontamination
from brooklet.llm.embedding_dedup import OP11_SQL, op11_embedding_near_dedup
from brooklet.llm.fingerprints import op3_document_fingerprints
from brooklet.llm.html_text import op10_html_extraction
from brooklet.llm.jaccard_join import OP2_SQL, op2_ngram_jaccard_join
from brooklet.llm.merkle import OP12_SQL, op12_merkle_manifest
from brooklet.llm.secrets import op9_secret_scans
from brooklet.llm.sentence_pieces import op5_sentencepiece
from brooklet.llm.substring_dedup import OP1_SQL, op1_substring_dedup
from brooklet.llm.toxicity import op7_toxicity
from brooklet.llm.vector_codes import OP13_SQL, op13_vector_code_compression
from brooklet.llm.warc import OP8_SQL, op8_warc

LLM_QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_chat_formatting": op4_chat_formatting,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_secret_scans": op9_secret_scans,
    "op10_html_extraction": op10_html_extraction,
    "op11_embedding_near_dedup": op11_embedding_near_dedup,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_vector_code_compression": op13_vector_code_compression,
    "pipeline": corpus_pipeline.run,
}

LLM_ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1_SQL,
    "op2_ngram_jaccard_join": OP2_SQL,
    "op4_chat_formatting": OP4_SQL,
    "op8_warc": OP8_SQL,
    "op11_embedding_near_dedup": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
    "op13_vector_code_compression": OP13_SQL,
}
