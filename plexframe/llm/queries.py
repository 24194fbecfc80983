"""The thin queries opN_<name> over the provided tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plexframe.llm import counting, jaccard, kit, lines, mixing, packing, pages, quality, search, shards, suffix_tree


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_groups(kit.documents(spark, sf_dir))


def op2_suffix_tree_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(kit.documents(spark, sf_dir))


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = kit.documents(spark, sf_dir).select("doc_id", "source", mixing.sized().alias("size"))
    return mixing.mix(docs, "doc_id", "source", "size").select("doc_id", "size", "source_size", "target", "taken")


def op4_impact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 5, 50, "vec_id", "embedding")


def op5_page_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = counting.token_counts(kit.documents(spark, sf_dir), _vocabulary("byte_bpe_50k.json"))
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"), "n_chunks")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(kit.documents(spark, sf_dir))


def op8_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = shards.write_ids(kit.documents(spark, sf_dir), _vocabulary("byte_bpe_50k.json"), end=0)
    return shards.read_ids(files).select(F.col("key").alias("doc_id"), "start", F.col("n_ids").alias("n_tokens"), "ids_crc32")


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(kit.documents(spark, sf_dir), _vocabulary("word_bpe_49k.json"), end=1)


def op10_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = lines.cleaned(kit.documents(spark, sf_dir))
    return x.select("_row.doc_id", F.col("_lines").cast("long").alias("n_lines"), F.col("_gone").cast("long").alias("n_removed"), F.char_length("_text").cast("long").alias("kept_chars"), F.crc32("_text").alias("kept_crc32"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_suffix_tree_score, op3_source_mix, op4_impact_search, op5_page_differencing, op6_token_counts, op7_quality_rules, op8_token_shards, op9_best_fit_packing, op10_fuzzy_line_dedup, pipeline)}

ORACLE_SQL: dict[str, str] = {}
