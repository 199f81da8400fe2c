"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from plinth.llm import (
    alignment, bpe, decontaminate, kneser_ney, language_id, lexical_search, quality, simhash, substring_dedup, suffix_dedup,
    token_counts, toxicity, warc,
)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_suffix_dedup": suffix_dedup.op2_suffix_dedup,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_language_id": language_id.op4_language_id,
    "op5_quality": quality.op5_quality,
    "op6_kneser_ney": kneser_ney.op6_kneser_ney,
    "op7_bpe": bpe.op7_bpe,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_warc": warc.op9_warc,
    "op10_simhash": simhash.op10_simhash,
    "op11_substring_dedup": substring_dedup.op11_substring_dedup,
    "op12_lexical_search": lexical_search.op12_lexical_search,
    "op13_token_alignment": alignment.op13_token_alignment,
}

SQL = {
    "op8_decontaminate": decontaminate.OP8_SQL,
    "op9_warc": warc.OP9_SQL,
    "op12_lexical_search": lexical_search.OP12_SQL,
}
