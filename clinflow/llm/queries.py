"""The named queries of this subpackage; each applies one operator to a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinflow.llm import (
    bpe, credentials, decontaminate, language, licences,
    minhash, mixture, privacy, shards, spelling, tokens, vptree, whitening)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokens.write_tokens(table(spark, sf_dir, "documents"), vocabulary())
    return tokens.read_index(spark, path)


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign(table(spark, sf_dir, "documents"), 16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return minhash.compare_with_next(docs, minhash.near_duplicates(docs))


def private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.digest(privacy.scan(table(spark, sf_dir, "documents")))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return credentials.digest(credentials.scan(table(spark, sf_dir, "documents")))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.train(docs.where(~language.held_out()))
    found = language.classify(docs.select("doc_id", "text"), model)
    return found.select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "accepted")


def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vptree.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


QUERIES = {
    "op1_token_files": token_files,
    "op2_sharding": sharding,
    "op3_fingerprints": fingerprints,
    "op4_decontamination": decontamination,
    "op5_source_mix": source_mix,
    "op6_secret_scan": secret_scan,
    "op7_private_data": private_data,
    "op8_language_id": language_id,
    "op9_licence_scan": licence_scan,
    "op10_simhash_near_dedup": simhash_near_dedup,
    "op11_embedding_whitening": embedding_whitening,
    "op12_spelling_variants": spelling_variants,
    "op13_bpe_round_trip": bpe_round_trip,
}
ORACLES: dict[str, str] = {}
