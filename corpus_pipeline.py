"""The corpus pipeline: filter, deduplicate, mix and pack documents.

Each stage takes (spark, docs, sf_dir), works on all documents its predecessor kept and returns a DataFrame; all
but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reeltide.llm import kneser_ney, mixing, ngram_join, packing, span_dedup
from reeltide.llm.scratch import Scratch, free_name

#: Not expressible in SQL: learned scores, hashed sampling and tokens are tested against brute force instead.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models reject go.

    Each row is judged by its own text, whether its id is null or repeated; null and empty texts are clean. Without labels
    nothing goes. Columns pass through, whatever they are called.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    id_, of = (free_name(n, docs.columns) for n in ("rejected_id", "rejected_of"))
    rejected = kneser_ney.toxicity(docs, labels).where("predicted = 1").select(F.col("doc_id").alias(id_), F.col("of").alias(of)).distinct()
    return docs.join(rejected, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.xxhash64(F.col("text").cast("string")) == F.col(of)), "left_anti")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by similar five-word shingles, one with the smallest id stays.

    Rows that repeat an id are one document, of which the row with the smallest hash of its text stays. Null and wordless texts are
    similar to nothing and stay, and so does every row with a null id.
    """
    groups = ngram_join.ngram_components(docs, words=5, num=80)
    surplus = free_name("surplus", docs.columns)
    others = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(surplus)).distinct()
    kept = docs.join(others, F.col("doc_id") == F.col(surplus), "left_anti")
    twice = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias(surplus)).agg(F.count("*").alias("n")).where("n > 1").select(surplus)
    if twice.isEmpty():
        return kept
    alike = kept.join(twice, F.col("doc_id") == F.col(surplus), "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), F.xxhash64("text")).alias("r")).select("r.*")
    return kept.join(twice, F.col("doc_id") == F.col(surplus), "left_anti").unionByName(alike)


def cut_repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentences of repeated passages go from all documents but the first that has them.

    Every document keeps its row, also where nothing is left of its text; null texts stay null. ``n_chars`` follows the text.
    """
    cut = span_dedup.remove_repeated_spans(docs)
    changed = F.col("sentences_removed") > 0
    return cut.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each source's documents as often as its target weight wants them.

    Null sources are one source; documents without words aren't taken; rows that repeat an id, or have none, are taken each by
    itself. A document that is taken twice has two rows, and ``n_chars`` follows the text of one that is taken in part.
    """
    mixed = mixing.mixed_documents(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of full sequences of neighbouring documents: every row's tokens, each in one piece; null texts have the end token only."""
    pieces = packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", one_of_each_group),
    ("substring dedup", cut_repeated_spans),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input; what the result doesn't read is deleted."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), "stage")
        scratch.keep_only(docs)
    return docs
