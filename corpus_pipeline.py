"""A training corpus from raw documents in five stages, each written as a table before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brightwater.llm.common import drop_matching, row_digest
from brightwater.llm.exact_dedup import keep_first_copies
from brightwater.llm.mixing import repeat_by_mix
from brightwater.llm.ngram_join import drop_near_copies
from brightwater.llm.packing import pack_documents
from brightwater.llm.quality_rules import quality_rules
from brightwater.session import materialize


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules or their host's verdict reject go. Each row is judged on its own text and source, whatever its id."""
    judged = quality_rules(docs.withColumn("digest", row_digest(F.col("text"))), host=F.col("source"), carry=["digest", "source"])
    gone = judged.filter("NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("digest").alias("gone_digest"), F.col("source").alias("gone_source")).distinct()
    return drop_matching(docs, materialize(gone, "quality-gone"), gone_id=F.col("doc_id"), gone_digest=row_digest(F.col("text")), gone_source=F.col("source"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id stays."""
    return keep_first_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that link by 5-word shingles at a similarity of 0.8, that with the least id stays."""
    return drop_near_copies(docs, words=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for every time that the mix takes a document."""
    return repeat_by_mix(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all that was taken, in sequences of 4096 tokens."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", by_quality), ("exact dedup", without_copies), ("n-gram Jaccard join", without_near_copies),
          ("mixing sources", mixed), ("best-fit packing", packed)]

#: Tokens can't be had in SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
