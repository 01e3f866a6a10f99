"""The operators' registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from civiclens.llm import automata, bpe, clusters, collocations, decontam, lines, pages, passages, quality, shards, simhash, topk, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_latent_decontamination": decontam.op1_latent_decontamination,
    "op2_warc_archive": warc.op2_warc_archive,
    "op3_host_suffix_pages": pages.op3_host_suffix_pages,
    "op4_byte_bpe": bpe.op4_byte_bpe,
    "op5_hypergeometric_shards": shards.op5_hypergeometric_shards,
    "op6_suffix_passages": passages.op6_suffix_passages,
    "op7_simhash_trie": simhash.op7_simhash_trie,
    "op8_maxscore_top5": topk.op8_maxscore_top5,
    "op9_pairwise_quality": quality.op9_pairwise_quality,
    "op10_line_variants": lines.op10_line_variants,
    "op11_automata_words": automata.op11_automata_words,
    "op12_vantage_clusters": clusters.op12_vantage_clusters,
    "op13_branch_phrases": collocations.op13_branch_phrases,
}

ORACLE: dict[str, str] = {
    "op2_warc_archive": warc.ORACLE,
    "op8_maxscore_top5": topk.ORACLE,
    "op12_vantage_clusters": clusters.ORACLE,
    "op13_branch_phrases": collocations.ORACLE,
}
