"""From raw documents to token ids, in five stages.

Each stage takes the session, the documents that the stage before it kept, and the
folder of the tables, and returns documents; the last returns what their encoding is.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keygroup.llm import mixing, neardup, pieces, pii, toxicity
from keygroup.llm.common import table
from keygroup.llm.registry import PII_KEY, pieces_path
from keygroup.names import quoted
from keygroup.workspace import materialise


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine does not call toxic."""
    machine = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, machine)


def beside(docs: DataFrame, added: set[str], operator: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What the operator makes of documents, with their columns, also those named like ``added`` ones."""
    prefix = "_own"
    while any(c.lower().startswith(prefix) for c in docs.columns):
        prefix = f"_{prefix}"
    names = [f"{prefix}{i}" if c.lower() in added else c for i, c in enumerate(docs.columns)]
    made = operator(docs.toDF(*names))
    return made.select(*(F.col(quoted(name)).alias(c) for name, c in zip(names, docs.columns)))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return beside(docs, {"class_id", "kept"}, lambda df: neardup.near_duplicates(df).where("kept"))


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in their texts and their lengths counted anew."""
    length = F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))
    return beside(docs, {"found"}, lambda df: pii.pseudonymised(df, PII_KEY).withColumn("n_chars", length))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    copy = F.explode(F.sequence(F.lit(1), F.col("copies")))
    added = {"size", "source_size", "target", "copies", "copy"}
    return beside(docs, added, lambda df: mixing.mix(df).where("copies > 0").withColumn("copy", copy))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every document taken, as their number and digests."""
    return pieces.digests(pieces.encode(docs, pieces_path()))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("pii", replace_personal_data),
    ("mixing", mix_sources),
    ("pieces", encode_pieces),
]

# SQL cannot express a trained classifier, sampling of draws or merges of pieces.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of ``sf_dir`` through all stages, each but the last written down."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
