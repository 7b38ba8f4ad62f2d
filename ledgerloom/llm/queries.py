"""The registered queries of this subpackage: each applies its operator to a whole table and derives digests."""

from __future__ import annotations

import zlib

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, chat, codes, frames, jaccard, packing, pii, pivots, quality, repeats, runs, tiles, warc


def _read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    judged = quality.judge(_read(spark, folder, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


CONFLICT = "</s>[INST] ok [/INST]"


def chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    rows = _read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    own = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), F.lit(CONFLICT).alias("text"))
    back = chat.read_chats(chat.format_chats(rows.unionByName(own)))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def token_files(spark: SparkSession, folder: str) -> DataFrame:
    return frames.read(frames.write(_read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), special_as_text=False))


def packed(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_read(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False, special_as_text=False)


def jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.join(_read(spark, folder, "documents"))


def repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    cut = repeats.remove(_read(spark, folder, "documents"))
    return cut.select("row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def warc_archives(spark: SparkSession, folder: str) -> DataFrame:
    back = warc.read(warc.write(_read(spark, folder, "pages")), with_payload=False)
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def top_k(spark: SparkSession, folder: str) -> DataFrame:
    return pivots.top_k(_read(spark, folder, "embeddings"))


def personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(_read(spark, folder, "documents"))
    line = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    of = lambda kind: F.filter("base", lambda s: s["kind"] == kind)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(line("base"), 256).alias("base_sha256"), line("spans").alias("spans"))


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coder = bpe.ByteBPE(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = coder.encode(_read(spark, folder, "documents"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(coder.as_bytes(F.col("ids")), 256).alias("ids_sha256"),
        F.sha2(coder.decode(F.col("ids")), 256).alias("decoded_sha256"),
    )


def vector_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return tiles.near_duplicates(_read(spark, folder, "embeddings"))


def planted_period(id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document, those of every tenth one (by the checksum of its id) periodic from some word on."""
    h = zlib.crc32(str(id).encode())
    if id is None or h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = runs.find(_read(spark, folder, "documents"), rewrite=planted_period)
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    best = F.aggregate("runs", F.col("runs")[0], lambda a, b: F.when(more(a, b), b).otherwise(a))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.withColumn("best", F.when(F.size("runs") > 0, best)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{x}").alias(x) for x in ("start", "length", "period")],
        F.expr("(best.length * 1000) div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded = codes.fit(_read(spark, folder, "embeddings"))
    return coded.with_label_error().select(
        F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256")
    )


QUERIES = {
    "op1_warc": warc_archives,
    "op2_top_k": top_k,
    "op3_byte_bpe": byte_bpe,
    "op4_quality_rules": quality_rules,
    "op5_chat_formatting": chat_formatting,
    "op6_jaccard_join": jaccard_join,
    "op7_token_files": token_files,
    "op8_packing": packed,
    "op9_personal_data": personal_data,
    "op10_repeats": repeated_passages,
    "op11_vector_duplicates": vector_duplicates,
    "op12_periodic_runs": periodic_runs,
    "op13_vector_codes": vector_codes,
}
