"""A corpus from raw documents to packed sequences: five stages, each written and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bizpulse.llm import line_dedup, ngram_join, packing, quality_gam, secrets
from bizpulse.llm.queries import held_out, tokenizer_file
from bizpulse.session import scratch_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels that may be learnt from, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    model = quality_gam.train(docs, labels)
    return quality_gam.classify(docs, model).filter("predicted = 1").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each line of ten or more characters stays in the first document that has it."""
    kept = line_dedup.dedup_lines(docs)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the first, of each group of near-duplicates stays."""
    found = ngram_join.similar_documents(docs).filter("doc_id <> class_id").select("doc_id")
    return docs.join(found.hint("merge"), "doc_id", "left_anti").select(*COLUMNS)


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a mark; the documents stay. One pass: the workers that a task starts stay for the stages that follow."""
    clean = secrets.find_secrets(docs, redacted="text")
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences: their places, their ids and a checksum of these."""
    pieces = packing.pack(docs, tokenizer_file("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [("quality", quality), ("lines", lines), ("near_copies", near_copies), ("secrets", no_secrets), ("packing", pack)]

#: The classifier, the sampled posterior and the tokenizer have no SQL form; tests compare the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
