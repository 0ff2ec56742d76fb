"""The operators of this subpackage as queries over the given tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ball_codes, chat, chunk_bpe, cotrain, fingerprint, host_quality, jaccard, language, packing, piece_bpe,
    pivot_clusters, url_filter, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# The rules of the URL query.
URL_RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, rules).drop("url")


def op2_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.compare_in_order(table(spark, folder, "documents"))


def op3_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "source")
    return host_quality.apply_quality_rules(documents, carry=("doc_id",)).drop("host_rejected")


# Texts below this many code points are a host of their own in the next query.
SHORT_TEXT = 315


def quality_sections(spark: SparkSession, folder: str) -> DataFrame:
    """The host rule on a host that deserves it: all short texts, in place of their sources."""
    documents = table(spark, folder, "documents")
    short = F.length(F.coalesce("text", F.lit(""))) < SHORT_TEXT
    section = F.when(short, "short").otherwise(F.col("source"))
    return host_quality.apply_quality_rules(
        documents.select("doc_id", "text", section.alias("section")), host="section",
        carry=("doc_id",)).drop("host_rejected")


def op4_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    features = cotrain.features_of(table(spark, folder, "documents"))
    model = cotrain.fit_features(features, table(spark, folder, "labels"))
    return cotrain.score_features(model, features).withColumn("kept", cotrain.kept(F.col("score")))


def op5_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, folder, "documents"))


def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(table(spark, folder, "documents"),
                          public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    found = language.identify(documents, language.learn(documents, vocabulary), vocabulary)
    return found.withColumn("held_out", language.held_out(F.col("doc_id")))


def _archived(archives: DataFrame) -> DataFrame:
    return warc.read_archives(archives).filter(F.col("kind") == "record").select(
        warc.page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        warc.page_of(F.col("refers_to")).alias("refers_to"))


def op8_warc(spark: SparkSession, folder: str) -> DataFrame:
    return _archived(warc.write_archives(table(spark, folder, "pages")))


def warc_salvage(spark: SparkSession, folder: str) -> DataFrame:
    """The same from archives with noise, false marks in it, before every member."""
    noise = b"\x00lost" + warc.MEMBER + warc.VERSION + b"1\r\nno header\r\n"
    return _archived(warc.write_archives(table(spark, folder, "pages"), before=noise))


# A conversation whose texts hold control strings.
CONTROL_CONVERSATION = (
    (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    extra = spark.createDataFrame(
        CONTROL_CONVERSATION, "conv_id long, turn long, role string, text string")
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    rendered = chat.render(chat.fold_events(chat.streamed_events(turns.unionByName(extra))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(
        t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (rendered.withColumns({"turns": chat.read_back(F.col("formatted")),
                                  "learned": chat.learned_text(F.col("formatted"), F.col("loss"))})
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(said, 256).alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"),
                    F.sha2("learned", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


def op10_piece_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return piece_bpe.digest_table(table(spark, folder, "documents"),
                                  public_tokenizers.path("piece_bpe_32k.model"))


def op11_centroid_clusters(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_clusters.inertia_table(table(spark, folder, "embeddings"))


def op12_chunk_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_bpe.digest_table(table(spark, folder, "documents"),
                                  public_tokenizers.path("byte_bpe_50k.json"))


def op13_ball_codes(spark: SparkSession, folder: str) -> DataFrame:
    return ball_codes.code_table(table(spark, folder, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_url_filter": op1_url_filter,
    "op2_fingerprint": op2_fingerprint,
    "op3_quality_rules": op3_quality_rules,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_ngram_jaccard": op5_ngram_jaccard,
    "op6_packing": op6_packing,
    "op7_language": op7_language,
    "op8_warc": op8_warc,
    "op9_chat_format": op9_chat_format,
    "op10_piece_bpe": op10_piece_bpe,
    "op11_centroid_clusters": op11_centroid_clusters,
    "op12_chunk_bpe": op12_chunk_bpe,
    "op13_ball_codes": op13_ball_codes,
    "quality_sections": quality_sections,
    "warc_salvage": warc_salvage,
}
