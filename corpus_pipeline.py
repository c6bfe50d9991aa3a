"""The corpus pipeline: quality rules first, tokens last."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from curatrix.llm.common import documents, drop_shared, made, materialise

#: SQL cannot run the trees, XXH64 or the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the base rules and the trees keep; rejected documents go."""
    from curatrix.llm.quality import fit_quality, keep_good

    return keep_good(docs, fit_quality(documents(spark, sf_dir), documents(spark, sf_dir, "labels")))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that an earlier document (or line) has; texts of which nothing is left go."""
    from curatrix.llm.line_dedup import drop_repeated_lines

    return drop_repeated_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near copies, by fingerprints and by five-word shingles of similarity 0.8 or more."""
    from curatrix.llm.simhash import keep_first_of_each

    return keep_first_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix of sources takes it."""
    from curatrix.llm.mixing import mix_documents

    return mix_documents(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of each remaining text's ids, byte spans and decoded text."""
    import public_tokenizers
    from curatrix.llm.piece_tokens import piece_digests

    return piece_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("simhash", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", encode_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each stage's rows are written and read again.

    What a stage wrote on its way, and the rows it read, are deleted once its
    own rows are written.
    """
    docs, read = documents(spark, sf_dir), []
    for name, stage in STAGES[:-1]:
        before = len(made)
        docs = materialise(stage(spark, docs, sf_dir), name)
        *working, written = made[before:]
        drop_shared(spark, working + read)
        read = [written]
    return STAGES[-1][1](spark, docs, sf_dir)
