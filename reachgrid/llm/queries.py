"""One query per operator, over its whole table, with the digests of the results."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reachgrid.llm import bpe, licenses, mixing, neighbours, packing, pii, quality, repair
from reachgrid.llm import simhash, token_counts, token_files, trie, warc
from reachgrid.llm.shared import store

#: Words of a shingle and differing bits, as the query's contract fixes them.
SHINGLE_WORDS = 4
LINK_BITS = 4


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(
        _table(spark, folder, "documents"), words=SHINGLE_WORDS, bits=LINK_BITS
    )
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def pack_tokens(spark: SparkSession, folder: str) -> DataFrame:
    pieces = packing.pack(
        _table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"),
        "doc_tokens", "sequence_id", "offset",
    )


def bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    found = bpe.round_trip(
        _table(spark, folder, "documents"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    )
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(_table(spark, folder, "documents"))


def token_file_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    found = token_files.round_trip(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2
    )
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def warc_archive(spark: SparkSession, folder: str) -> DataFrame:
    index = warc.archive(_table(spark, folder, "pages"))
    return warc.read_archives(index).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def _count(kind: str):
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.personal_data(_table(spark, folder, "documents"))
    return found.select(
        F.col("key").alias("doc_id"),
        *[_count(kind) for kind in pii.KINDS],
        F.sha2(pii.spelled("base"), 256).alias("base_sha256"),
        pii.spelled("spans").alias("spans"),
    )


def section_tokens(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.section_counts(
        _table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    found = quality.verdicts(_table(spark, folder, "documents"))
    return found.select(
        F.col("key").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return neighbours.nearest(vectors, vectors.filter("vec_id % 50 = 0"))


def _crc32(*parts: Column) -> Column:
    return F.crc32(F.concat_ws(":", *parts).cast("binary"))


def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    convs = _table(spark, folder, "conversations")
    key = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    rows = repair.read_rows(convs, "conv_id", "turn", "role", "text")
    rows = repair.damaged(rows, _crc32(*key) % 20)
    found, edited = repair.repair(rows, ids=convs.select("conv_id"))
    digests = repair.spelled_digests(edited).withColumnRenamed("conv_id", "__conv")
    return found.join(digests, found["conv_id"].eqNullSafe(digests["__conv"]), "left").select(
        *found.columns, F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256")
    )


def prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    convs = _table(spark, folder, "conversations")
    turns = store(trie.turns_of(convs, "conv_id", "turn", "role", "text"), "turns")
    conv = F.col("conv_id")
    rebuilt = trie.with_shared_start(turns, conv - conv % 100, (_crc32(conv.cast("string")) % 6).cast("int"))
    return trie.trie(rebuilt)


def source_mix(spark: SparkSession, folder: str) -> DataFrame:
    found = mixing.mix(_table(spark, folder, "documents"), (3, 1, 2), share=1.5, most=2)
    return found.withColumnRenamed("key", "doc_id").select(
        "doc_id", "size", "source_size", "target", "taken", "position"
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_dedup": simhash_dedup,
    "op2_packing": pack_tokens,
    "op3_byte_bpe": bpe_round_trip,
    "op4_license_scan": license_scan,
    "op5_token_files": token_file_round_trip,
    "op6_warc": warc_archive,
    "op7_personal_data": personal_data,
    "op8_token_counts": section_tokens,
    "op9_quality_rules": quality_rules,
    "op10_nearest": nearest_vectors,
    "op11_conversation_repair": conversation_repair,
    "op12_prefix_trie": prefix_trie,
    "op13_source_mix": source_mix,
}
