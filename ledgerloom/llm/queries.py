"""The queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers
from ledgerloom.llm.binary_records import binary_records
from ledgerloom.llm.byte_bpe import round_trip_digest
from ledgerloom.llm.decontaminate import benchmark_leaks
from ledgerloom.llm.language_id import language_posteriors
from ledgerloom.llm.lexical_search import ranked_search
from ledgerloom.llm.license_scan import license_notices
from ledgerloom.llm.line_templates import without_recurring_lines
from ledgerloom.llm.mixing import mix_report
from ledgerloom.llm.ngram_join import ngram_join
from ledgerloom.llm.quality_rules import quality_rules
from ledgerloom.llm.secret_scan import secret_digest
from ledgerloom.llm.token_counts import token_counts
from ledgerloom.llm.whitening import whitened

TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_multi_50k.tiktoken"

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES: dict[str, Query] = {
    "op1_ngram_join": lambda spark, sf_dir: ngram_join(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"),
    "op2_quality_rules": lambda spark, sf_dir: quality_rules(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op3_decontaminate": lambda spark, sf_dir: benchmark_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op4_secret_scan": lambda spark, sf_dir: secret_digest(table(spark, sf_dir, "documents")),
    "op5_license_scan": lambda spark, sf_dir: license_notices(table(spark, sf_dir, "documents")),
    "op6_binary_records": lambda spark, sf_dir: binary_records(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)).drop("file", "offset"),
    "op7_mixing": lambda spark, sf_dir: mix_report(table(spark, sf_dir, "documents")),
    "op8_line_templates": lambda spark, sf_dir: without_recurring_lines(table(spark, sf_dir, "documents")),
    "op9_language_id": lambda spark, sf_dir: language_posteriors(
        table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")),
    "op10_token_counts": lambda spark, sf_dir: token_counts(
        table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER)),
    "op11_whitening": lambda spark, sf_dir: whitened(table(spark, sf_dir, "embeddings")),
    "op12_byte_bpe": lambda spark, sf_dir: round_trip_digest(
        table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN),
    "op13_ranked_search": lambda spark, sf_dir: ranked_search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
}

ORACLE: dict[str, str] = {}
