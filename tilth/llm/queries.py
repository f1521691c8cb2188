"""The dealt operators as queries over the standard tables: name -> (query, SQL or None)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tilth.llm import context_tree, html_text, hyperminhash, pfor, phrases, pieces, quality, shards, simhash, suffixes, trie, urls, winnow


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


CASES = {
    "op1_simhash": (lambda s, d: simhash.digests(table(s, d, "documents")), None),
    "op2_boosted_urls": (lambda s, d: urls.verdicts(table(s, d, "pages")), None),
    "op3_html_templates": (lambda s, d: html_text.texts(table(s, d, "pages")), None),
    "op4_histogram_shards": (lambda s, d: shards.shard(table(s, d, "documents")), None),
    "op5_winnowing": (lambda s, d: winnow.digests(table(s, d, "documents"), table(s, d, "benchmark")), None),
    "op6_token_blocks": (lambda s, d: pfor.digests(table(s, d, "documents")), None),
    "op7_sentencepiece": (lambda s, d: pieces.digests(table(s, d, "documents")), None),
    "op8_weak_supervision": (lambda s, d: quality.verdicts(table(s, d, "documents")), None),
    "op9_context_tree": (lambda s, d: context_tree.digests(table(s, d, "documents")), None),
    "op10_suffix_array": (lambda s, d: suffixes.digests(table(s, d, "documents")), None),
    "op11_prefix_trie": (lambda s, d: trie.digests(table(s, d, "conversations")), trie.SQL),
    "op12_hyperminhash": (lambda s, d: hyperminhash.digests(table(s, d, "documents")), hyperminhash.SQL),
    "op13_collocations": (lambda s, d: phrases.collocations(table(s, d, "documents")), phrases.SQL),
}
