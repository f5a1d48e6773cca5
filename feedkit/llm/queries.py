"""The operators' queries over the given tables, and SQL for those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedkit.llm import bpe, spelling, sql, turns
from feedkit.llm.classifier import classify
from feedkit.llm.common import table
from feedkit.llm.exact import deduplicate
from feedkit.llm.html import extract
from feedkit.llm.mixing import mix
from feedkit.llm.near import near_duplicates
from feedkit.llm.packing import pack
from feedkit.llm.passages import repeated_passages
from feedkit.llm.pii import find
from feedkit.llm.quality import quality
from feedkit.llm.token_counts import token_counts


def op1_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mix(table(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents")).drop("removed")


def op5_pack(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op6_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality(table(spark, folder, "documents")).drop("longest_repeat")


def op7_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find(table(spark, folder, "documents"))


def op8_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))


def op9_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), size=3, least=85).drop("file", "row", "first")


def op10_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return deduplicate(table(spark, folder, "documents")).drop("file", "row")


def op11_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    rows = bpe.there_and_back(docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    joined = F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary")
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    given = table(spark, folder, "conversations")
    named = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    harm = F.crc32(F.encode(F.concat_ws(":", *named), "utf-8")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(harm == 1, "").when(harm == 2, F.translate(text, ".!?", "")).otherwise(text)
    damaged = given.select("conv_id", "turn", F.when(harm == 4, "user").otherwise(role).alias("role"), text.alias("text"), harm.alias("harm"))
    twice = F.explode(F.array_repeat(F.lit(1), F.when(F.col("harm") == 3, 2).otherwise(1)))
    return turns.reports(damaged.withColumn("copy", twice), stays=F.col("harm") != 0)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    runs = spelling.runs(table(spark, folder, "documents"), 7)
    mark = F.crc32(F.encode(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "run"), "utf-8"))
    at = (mark % F.char_length("run")).cast("int")
    damaged = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.select(F.when(mark % 31 == 0, damaged).otherwise(F.col("run")).alias("word"))
    return spelling.variants(spelling.counted(words, 7, 2), 7)


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_mix_sources, op3_quality_classifier, op4_repeated_passages, op5_pack, op6_quality_rules, op7_pii, op8_html_extraction, op9_near_duplicates, op10_exact_dedup, op11_byte_bpe, op12_conversation_repair, op13_spelling_variants)}
ORACLE = {"op2_mix_sources": sql.MIX, "op6_quality_rules": sql.QUALITY, "op10_exact_dedup": sql.EXACT, "op12_conversation_repair": sql.REPAIR, "op13_spelling_variants": sql.SPELLING}
