"""The queries of this package and the same answers as SQL, where SQL can say them."""

from __future__ import annotations

from kilnmark.llm import (
    bpe,
    chat,
    cover_tree,
    divergence,
    htmltext,
    langid,
    merkle,
    ngram_join,
    packing,
    quality,
    secret_scan,
    suffix_dedup,
    warc,
)

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_ngram_join": ngram_join.op2_ngram_join,
    "op3_bpe": bpe.op3_bpe,
    "op4_html_text": htmltext.op4_html_text,
    "op5_quality_rules": quality.op5_quality_rules,
    "op6_warc": warc.op6_warc,
    "op7_embedding_dedup": cover_tree.op7_embedding_dedup,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_chat_format": chat.op9_chat_format,
    "op10_language_id": langid.op10_language_id,
    "op11_merkle_manifest": merkle.op11_merkle_manifest,
    "op12_source_divergence": divergence.op12_source_divergence,
    "op13_secret_scan": secret_scan.op13_secret_scan,
}
ORACLE = {
    "op5_quality_rules": quality.ORACLE,
    "op6_warc": warc.ORACLE,
    "op9_chat_format": chat.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
    "op12_source_divergence": divergence.ORACLE,
}
