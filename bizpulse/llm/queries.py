"""The registered queries of this package and their SQL: thin digests of what the operators return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bizpulse.llm import (
    cap_filters,
    chat_format,
    collocations,
    host_rules,
    line_dedup,
    ngram_join,
    packing,
    pii,
    quality_gam,
    sampled_pieces,
    secrets,
    spelling,
    warc_zst,
)
from bizpulse.llm.sql import ORACLE


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _count(spans: str, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def _joined(spans: str | Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(_table(spark, sf_dir, "documents"))
    base = F.filter("pii", lambda s: s["kind"].isin(*pii.BASE))
    return found.select(
        "doc_id", *(_count("pii", kind).alias(f"n_{kind}") for kind in pii.BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined("pii").alias("spans"),
        F.size("pii").cast("long").alias("n_spans"),
    )


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(_table(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zst.archive_round_trip(_table(spark, sf_dir, "pages"))
    return records.select(
        F.col("record_id").try_cast("long").alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").try_cast("long").alias("refers_to")
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_table(spark, sf_dir, "documents"))
    base = F.filter("secrets", lambda s: s["kind"].isin(*secrets.BASE))
    return found.select(
        "doc_id", *(_count("secrets", kind).alias(f"n_{kind}") for kind in secrets.BASE), F.sha2(_joined(base), 256).alias("base_sha256"), _joined("secrets").alias("spans")
    )


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves no remainder by 5."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_gam.train(docs, _table(spark, sf_dir, "labels").filter(~held_out()))
    return quality_gam.classify(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op8_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_vectors(_table(spark, sf_dir, "embeddings"))


def op9_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    coded = sampled_pieces.decode_pieces(sampled_pieces.encode_texts(docs, model), model)
    return coded.select(
        "doc_id", F.size("pieces").cast("long").alias("n_pieces"), F.xxhash64("pieces").alias("ids_hash"), (F.col("decoded") == F.col("text")).alias("lossless")
    )


def op10_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.apply_rules(_table(spark, sf_dir, "documents")).select(
        "doc_id", *host_rules.COUNTS, "base_failed", "kept", "host", F.round("host_rate", 9).alias("host_rate")
    )


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(_table(spark, sf_dir, "documents")))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    told = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    made = chat_format.format_chats(told.union(more)).withColumns({"turns": chat_format.read_chats(F.col("formatted")), "trained": chat_format.loss_text(F.col("segments"))})
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return made.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("trained").cast("long").alias("loss_chars"),
        F.sha2("trained", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"), "valid", "bad_turn",
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_pii, op2_ngram_join, op3_line_dedup, op4_warc, op5_secrets, op6_quality, op7_packing, op8_cap_filters,
        op9_sampled_pieces, op10_host_rules, op11_spelling, op12_collocations, op13_chat_format,
    ]
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
