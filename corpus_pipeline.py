"""A training-data pipeline over the documents table.

Stages, in order: toxic documents go, documents of low quality go, one document of
each near-duplicate group stays, and what is left is packed into sequences. Each
stage works on all that its predecessor kept; the driver of the pipeline writes each
stage's rows as a table that the next one reads. All stages but the last return the
columns of the documents table.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrar.llm import minhash, packing, quality, toxicity
from registrar.llm.common import crc_mod, staged, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
_SCORE = "__pipeline_score"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't predict toxic. Labels of a fifth
    of the ids stay held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(crc_mod(F.col("doc_id"), 5) != 0)
    model = toxicity.fit(docs, labels)
    return toxicity.with_score(docs, model, _SCORE).filter(F.col(_SCORE) < 0.5).drop(_SCORE)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble predicts good. Labels of a third of the ids
    stay held out."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").filter(crc_mod(F.col("doc_id"), 3) != 1)
    model = quality.fit(docs, labels)
    return quality.with_score(docs, model, _SCORE, filtered=True).filter(F.col(_SCORE) >= 0.5).drop(_SCORE)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group whose sets of 5-word shingles
    reach Jaccard 0.8. Rows with a null doc_id stay. Rows with one doc_id stay if that
    doc_id is kept; of rows alike in all columns one stays."""
    marked = minhash.near_duplicates(docs, minhash.Settings(shingle=5))
    ids = marked.groupBy("doc_id").agg(F.bool_or(F.coalesce("kept", F.lit(True))).alias("kept"), F.count("*").alias("rows"))
    # the ids that don't stay as they are, few beside the others: the texts needn't be shuffled for them
    other = staged(ids.filter("not kept or rows > 1 or doc_id is null"), "other-ids")
    sent = F.broadcast if other.count() <= minhash.BROADCAST_IDS else (lambda df: df)
    several = sent(other.filter("kept").select("doc_id"))
    out = docs.join(sent(other.select("doc_id")), "doc_id", "left_anti").filter("doc_id is not null")
    return out.unionByName(docs.join(several, docs["doc_id"].eqNullSafe(several["doc_id"]), "left_semi").dropDuplicates())


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, VOCABULARY)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("packing", pack_sequences),
]

#: The classifiers' fits and the sketches have no SQL form; tests hold the stages
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, name)
    return docs
