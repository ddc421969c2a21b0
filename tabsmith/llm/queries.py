"""The queries of this subpackage and, where SQL can express them, their DuckDB twins."""

from __future__ import annotations

from tabsmith.llm import (bpe, compression, decontaminate, jaccard, kneser_ney, langid, mixing, phrases, sharding, suffix_dedup,
                          topk, urls, variants)

QUERIES = {
    "op1_shard": sharding.op1_shard,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_url_filter": urls.op3_url_filter,
    "op4_language_id": langid.op4_language_id,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_compression_bands": compression.op6_compression_bands,
    "op7_pivot_topk": topk.op7_pivot_topk,
    "op8_ngram_jaccard": jaccard.op8_ngram_jaccard,
    "op8_ngram_jaccard_links": jaccard.op8_ngram_jaccard_links,
    "op9_kneser_ney": kneser_ney.op9_kneser_ney,
    "op10_mix_sources": mixing.op10_mix_sources,
    "op11_spelling_variants": variants.op11_spelling_variants,
    "op12_decontaminate": decontaminate.op12_decontaminate,
    "op13_phrases": phrases.op13_phrases,
}

ORACLE = {
    "op3_url_filter": urls.SQL,
    "op5_suffix_dedup": suffix_dedup.SQL,
    "op7_pivot_topk": topk.SQL,
    "op8_ngram_jaccard": jaccard.SQL,
    "op8_ngram_jaccard_links": jaccard.LINKS_SQL,
    "op10_mix_sources": mixing.SQL,
    "op11_spelling_variants": variants.SQL,
    "op12_decontaminate": decontaminate.SQL,
    "op13_phrases": phrases.SQL,
}
