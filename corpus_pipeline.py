"""A corpus pipeline: documents to packed training sequences, one operator of plexframe.llm for each stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet and reads it
again as the next stage's docs. All stages but the last return the columns of documents.

Defined results of all stages: a null text counts as empty, a null id or source as a value of its own, other columns are
passed through whatever their names, rows given twice are documents given twice, and an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plexframe.llm import jaccard, kit, lines, mixing, packing, quality


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that a quality rule rejects; empty texts are among them."""
    return quality.filter_rows(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines, keeping one occurrence of each group of like lines; a document of whose words nothing stays
    repeats others whole and is dropped. Rows equal in id and text are one document."""
    return lines.dedup_rows(docs, waves=2)  # disk is scarcer here than time


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps, of each group of near-duplicate documents, the one with the smallest id; texts without words are in no group."""
    return jaccard.keep_one(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or cuts each source to its target; the document on which a budget falls keeps its first words.

    Copies of a document share its id; documents without words are in no mix."""
    return mixing.mix_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mix with their sequences and places; a copy is told from another by its sequence and place."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [(f.__name__, f) for f in (quality_rules, line_dedup, ngram_jaccard_join, source_mix, best_fit_packing)]

#: Near-duplicate groups, fuzzy lines and packing are iterative or need a tokenizer: the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over documents; scratch tables of a stage go when its output is written."""
    docs, old = kit.documents(spark, sf_dir), None
    for name, stage in STAGES:
        with kit.scratch_of_a_step(spark):
            docs, new = kit.keep(stage(spark, docs, sf_dir), name)
            kit.release(new)
        if old:
            kit.remove(spark, old)
        old = new
    return docs
