"""The queries of this subpackage and their SQL."""

from minutelake.llm import chat, conversation_repair, language_id, mixing, ngram_jaccard, packing, quality_rules, suffix_dedup, token_counts, topk, url_filters, warc, whitening

QUERIES = {
    "op1_ngram_jaccard_join": ngram_jaccard.op1_ngram_jaccard_join,
    "op2_token_counts": token_counts.op2_token_counts,
    "op3_chat_formatting": chat.op3_chat_formatting,
    "op4_language_id": language_id.op4_language_id,
    "op5_best_fit_packing": packing.op5_best_fit_packing,
    "op6_url_filters": url_filters.op6_url_filters,
    "op7_mixing": mixing.op7_mixing,
    "op8_warc": warc.op8_warc,
    "op9_exact_topk": topk.op9_exact_topk,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_embedding_whitening": whitening.op12_embedding_whitening,
    "op13_suffix_dedup": suffix_dedup.op13_suffix_dedup,
    "language_id_pages": language_id.pages_language_id,
}

ORACLE = {
    "op1_ngram_jaccard_join": ngram_jaccard.OP1_SQL,
    "op3_chat_formatting": chat.OP3_SQL,
    "op8_warc": warc.OP8_SQL,
    "op9_exact_topk": topk.OP9_SQL,
}
