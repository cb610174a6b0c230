"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from . import chat, fim, fingerprints, hilbert, html_tree, mixing, ngram_join, ogg, secrets, spm, token_align, toxicity, warc_zip

QUERIES = {
    "op1_chat_formatting": chat.op1_chat_formatting,
    "op2_fingerprints": fingerprints.op2_fingerprints,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_warc_zip": warc_zip.op4_warc_zip,
    "op5_mix_sources": mixing.op5_mix_sources,
    "op6_hilbert_shards": hilbert.op6_hilbert_shards,
    "op7_secret_scans": secrets.op7_secret_scans,
    "op8_sentencepiece": spm.op8_sentencepiece,
    "op9_ngram_jaccard_join": ngram_join.op9_ngram_jaccard_join,
    "op10_ogg_media": ogg.op10_ogg_media,
    "op11_token_alignment": token_align.op11_token_alignment,
    "op12_html_tree": html_tree.op12_html_tree,
    "op13_fill_in_middle": fim.op13_fill_in_middle,
}

ORACLE_SQL: dict[str, str] = {
    "op1_chat_formatting": chat.OP1_SQL,
    "op4_warc_zip": warc_zip.OP4_SQL,
    "op11_token_alignment": token_align.op11_token_alignment,
    "op13_fill_in_middle": fim.OP13_SQL,
}
