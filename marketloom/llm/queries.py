"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from marketloom.llm import (
    archive, decontamination, language, mixing, near_copies, nearest, oracles, phrases, prefix_trie, repeats, secrets_scan, sharding,
    token_files, url_filter,
)
from marketloom.llm.common import table

QUERIES = {
    "op1_language": lambda spark, folder: language.identified(table(spark, folder, "documents")),
    "op2_secrets": lambda spark, folder: secrets_scan.secrets(table(spark, folder, "documents")),
    "op3_shards": lambda spark, folder: sharding.sharded(table(spark, folder, "documents")),
    "op4_repeats": lambda spark, folder: repeats.without_repeats(table(spark, folder, "documents")),
    "op5_nearest": lambda spark, folder: nearest.nearest(table(spark, folder, "embeddings")),
    "op6_tokens": lambda spark, folder: token_files.tokenized(table(spark, folder, "documents")),
    "op7_mix": lambda spark, folder: mixing.taken_words(table(spark, folder, "documents")),
    "op8_near_copies": lambda spark, folder: near_copies.near_duplicates(table(spark, folder, "documents")),
    "op9_leaks": lambda spark, folder: decontamination.contaminated(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")),
    "op10_urls": lambda spark, folder: url_filter.judge(table(spark, folder, "pages")),
    "op11_phrases": lambda spark, folder: phrases.collocations(table(spark, folder, "documents")),
    "op12_trie": lambda spark, folder: prefix_trie.trie(table(spark, folder, "conversations")),
    "op13_warc": lambda spark, folder: archive.archived(table(spark, folder, "pages")),
}

ORACLE: dict[str, str] = {"op11_phrases": oracles.PHRASES, "op12_trie": oracles.TRIE, "op13_warc": oracles.ARCHIVE}
"""The other queries rest on models, sketches, schedules and files that SQL has no form for: ``tests/llm`` has their checks."""
