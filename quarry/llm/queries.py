"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import (bpe, chat, conversation_repair, decontaminate, exact_dedup, line_chunks, merkle, near_dedup, pii,
                        planes, quality, url_filter, warc)
from quarry.session import scratch_path
from quarry.sources.tables import load_table


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(load_table(spark, sf_dir, "documents"), load_table(spark, sf_dir, "benchmark"))


def op2_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.deduplicated(load_table(spark, sf_dir, "documents"), passages=True)


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    return quality.scored(docs, quality.fit(docs, load_table(spark, sf_dir, "labels")))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    added = spark.createDataFrame([(-1, 0, "user", chat.HOSTILE), (-1, 1, "assistant", chat.HOSTILE)],
                                  "conv_id long, turn long, role string, text string")
    rows = load_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(added)
    return chat.read_back(chat.formatted(rows, path), path).drop("n_tokens")


def op5_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    chunks = planes.written(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return planes.read_back(chunks, planes.chunk_index(chunks))


def op6_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(load_table(spark, sf_dir, "documents"))


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(load_table(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = pii.scanned(load_table(spark, sf_dir, "documents"))
    return pii.spans_found(spans, pii.fit(spans))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load_table(spark, sf_dir, "documents")
    return exact_dedup.memberships_in_batches(docs, exact_dedup.DigestIndex(spark))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judged(load_table(spark, sf_dir, "pages"), url_filter.RULES)


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repaired(load_table(spark, sf_dir, "conversations"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(load_table(spark, sf_dir, "documents"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load_table(spark, sf_dir, "pages")
    arcs = scratch_path(spark, "arc")
    older = F.coalesce(F.crc32(F.col("page_id").cast("string")) % 2 == 0, F.lit(False))
    warc.write_arc(pages.where(older), f"{arcs}/v1", version=1)
    warc.write_arc(pages.where(~older), f"{arcs}/v2", version=2)
    archive = scratch_path(spark, "warc")
    warc.convert(spark, [f"{arcs}/v1", f"{arcs}/v2"], archive)
    return warc.resolved(warc.read_warc(spark, archive))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_line_chunks": op2_line_chunks,
    "op3_quality": op3_quality,
    "op4_chat": op4_chat,
    "op5_planes": op5_planes,
    "op6_near_dedup": op6_near_dedup,
    "op7_bpe": op7_bpe,
    "op8_pii": op8_pii,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_url_filter": op10_url_filter,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_merkle": op12_merkle,
    "op13_warc": op13_warc,
}

ORACLE: dict[str, str] = {
    "op4_chat": chat.SQL,
    "op6_near_dedup": near_dedup.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op10_url_filter": url_filter.SQL,
    "op11_conversation_repair": conversation_repair.SQL,
    "op12_merkle": merkle.SQL,
    "op13_warc": warc.SQL,
}
