"""The registered queries: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, captures, chat, exact_dedup, language_id, mixing, packing, records, rtree, set_join, setm, style_tree, suffix_array, warc


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), 20)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.extract(table(spark, sf_dir, "pages"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return set_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc.resolve(warc.parse(captures.crawl(table(spark, sf_dir, "pages"))))
    lines = F.array_join(F.transform("headers", lambda h: F.concat(h["name"], F.lit(": "), h["value"])), "\n")
    return found.withColumn("headers", lines).withColumn("date", F.unix_seconds("date")).withColumn("original_date", F.unix_seconds("original_date"))


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_documents(table(spark, sf_dir, "documents")).drop("hash")


def op9_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_format_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digest_chunks(chat.format_chunks(turns))


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_array.digest(suffix_array.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return rtree.hard_negatives(table(spark, sf_dir, "embeddings"), 100, label=moved)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setm.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_nearest": op1_nearest,
    "op2_mix_sources": op2_mix_sources,
    "op3_main_text": op3_main_text,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_revisits": op6_revisits,
    "op7_token_records": op7_token_records,
    "op8_language_id": op8_language_id,
    "op9_pack": op9_pack,
    "op10_format_chat": op10_format_chat,
    "op11_decontaminate": op11_decontaminate,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_collocations": op13_collocations,
}
