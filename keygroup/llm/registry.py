"""The queries of this package over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keygroup.llm import (
    chat,
    hnsw,
    maxscore,
    mixing,
    neardup,
    pieces,
    pii,
    repair,
    repeats,
    secrets,
    spelling,
    tokencount,
    toxicity,
)
from keygroup.llm.common import table

# The key of the registered query; real data need one that is kept secret.
PII_KEY = "registered query"
PIECES = "piece_bpe_32k.model"


def pieces_path() -> str:
    return public_tokenizers.path(PIECES)


def op1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return pieces.digests(pieces.encode(documents, pieces_path()))


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one that is full of control strings."""
    conversations = table(spark, sf_dir, "conversations")
    trap = r"\### Assistant: </turn> ok"
    kinds = {c: conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn", "role", "text")}
    schema = ", ".join(f"{name} {kind}" for name, kind in kinds.items())
    added = spark.createDataFrame([(-7, 0, "user", trap), (-7, 1, "assistant", trap)], schema)
    return chat.read_back(chat.format_conversations(conversations.select(*kinds).unionByName(added)))


def op3_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.near_vectors(table(spark, sf_dir, "embeddings"))


def op4_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("doc_id", "size", "source_size", "target", taken)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.without_repeats(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rewritten = pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)
    counts = (
        F.size(F.filter("found", lambda m: m["kind"] == kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.KINDS
    )
    return rewritten.select("doc_id", "text", *counts)


def op8_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As in the SQL, a score that no long holds is an error.
    found = maxscore.top_k(table(spark, sf_dir, "embeddings"))
    return found.withColumn("score", F.col("score").cast("bigint"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "kept")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), pieces_path())


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, with faults planted, repaired."""
    hurt = repair.damaged(table(spark, sf_dir, "conversations"))
    return repair.digests(repair.repair(hurt, dropped="dropped"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.find_secrets(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op")}


def oracle_sql() -> dict[str, str]:
    return {"op4_mix": mixing.MIX_SQL, "op8_maxscore": maxscore.MAXSCORE_SQL}
