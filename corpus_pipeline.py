"""Corpus pipeline over ``documents``: quality, near duplicates, repeated passages, mixing, tokens.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir) and returns the rows it keeps, with
the columns of documents (the last one adds its own). ``run`` writes each stage as Parquet to the shared
folder and reads it again as the next one's input.

Rows with nulls, empty and very long texts, ties and repeated rows go through every stage as the operators'
docstrings say; an empty table comes out empty; columns beyond those of documents are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from floe.llm import mixing, ordinal_quality, piece_bpe, queries, simhash, suffix_dedup
from floe.session import materialize, ship_package


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade reaches ``ordinal_quality.MIN_TAIL``; the others go."""
    ship_package(spark)
    labels = queries.table(spark, sf_dir, "labels")
    rated = ordinal_quality.rate_documents(docs, queries.graded(labels))
    return rated.where(F.col("quality.tail") >= ordinal_quality.MIN_TAIL).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group (3-word shingles, 2 bits): that of the smallest id."""
    ship_package(spark)
    return simhash.keep_one(docs, shingle=3, max_bits=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes that lie in a 200-byte string found elsewhere too; ``n_chars`` follows.

    Bytes of characters that a cut went through are left out. A document of which no character is left goes,
    unless it was empty before.
    """
    ship_package(spark)
    d = suffix_dedup.remove_repeats(docs, min_bytes=200, as_text=True)
    kept = F.when(F.col("dedup.n_removed") > 0, F.col("dedup.kept")).otherwise(F.col("text"))
    d = d.withColumn("_kept", kept).where((F.col("dedup.n_removed") == 0) | (F.length("_kept") > 0))
    changed = {"text": F.col("_kept")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("dedup.n_removed") > 0, F.length("_kept").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return d.withColumns(changed).select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies of each document that the mix takes (none to three), as rows in training order.

    The order holds for the frame returned only: stages keep the columns of documents, so no row carries its position,
    and the written table is read in any order. ``op10_mix_sources`` returns the positions.
    """
    ship_package(spark)
    return mixing.training_order(mixing.mix(docs))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their token ids. They are only encoded here; ``op2_sentencepiece`` decodes them too."""
    ship_package(spark)
    d = piece_bpe.encode_documents(docs, queries.PIECE_MODEL)
    return d.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("mixing sources to target weights", mixed_sources),
    ("SentencePiece encoding and decoding", tokens),
]

#: Neither the fitted model nor hashing by XXH64 is SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.split()[0].lower())
    return docs
