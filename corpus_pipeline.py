"""Documents to training windows: drop toxic texts, repeated lines and near-duplicates, then pack what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from plyscope.llm import lines, minhash, packing, toxicity
from plyscope.llm.common import stored, table

#: The stages cannot be expressed in SQL; the tests hold them against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose toxicity score stays below the threshold."""
    return without_toxic(docs, table(spark, folder, "labels"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The same by given labels. The columns go by numbers meanwhile, so that none clashes with the score."""
    model = toxicity.fit(docs, labels)
    numbered = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)])
    scored = toxicity.score(numbered, model, f"c{docs.columns.index('text')}")
    kept = scored.where(F.col("score") < toxicity.THRESHOLD)
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, without the lines that match an earlier one; n_chars follows the text."""
    done = lines.dedup_lines(docs, linked=False)
    if "n_chars" in docs.columns:
        changed = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
        done = done.withColumn("n_chars", changed.cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of every class of near-duplicates: the one with the smallest id."""
    return minhash.one_of_each(docs).select(*docs.columns)


def pack_windows(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The pieces of all documents with their place in the windows."""
    import public_tokenizers

    pieces = packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packing.pack(pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_each),
    ("packing", pack_windows),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
