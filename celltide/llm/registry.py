"""Registered queries of the operators, and their SQL where SQL can express them."""

from celltide.llm import (
    alignment,
    bpe,
    edits,
    hnsw,
    lexical,
    minhash,
    mixing,
    packing,
    quality,
    secrets,
    sharding,
    threads,
    urls,
)

QUERIES = {
    "op1_hnsw_near_dups": hnsw.query,
    "op2_mix_sources": mixing.query,
    "op3_minhash_near_dups": minhash.query,
    "op4_secret_scan": secrets.query,
    "op5_byte_bpe": bpe.query,
    "op6_quote_threads": threads.query,
    "op7_edit_token_counts": edits.query,
    "op8_url_filter": urls.query,
    "op9_quality_rules": quality.query,
    "op10_rendezvous_shards": sharding.query,
    "op11_best_fit_packing": packing.query,
    "op12_norm_bucket_search": lexical.query,
    "op13_tokenizer_alignment": alignment.query,
}

ORACLES = {
    "op1_hnsw_near_dups": hnsw.ORACLE,
    "op2_mix_sources": mixing.ORACLE,
    "op3_minhash_near_dups": minhash.ORACLE,
    "op10_rendezvous_shards": sharding.ORACLE,
    "op12_norm_bucket_search": lexical.ORACLE,
}
