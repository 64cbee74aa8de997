"""From raw documents to packed token sequences.

Each stage calls one operator of ``clickpulse.llm`` and its result is written
to the shared folder before the next stage reads it:

1. quality rules: documents that the rules reject go;
2. near-duplicates: one document of each SimHash group stays;
3. benchmark decontamination: hit spans are cut out, and documents that they
   mostly consist of go;
4. secret scan: secrets are masked, documents stay;
5. packing: one row per piece of a document in a token sequence.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickpulse.llm.common import read_table, remove, stored
from clickpulse.llm.decontaminate import decontaminate
from clickpulse.llm.packing import pack_documents
from clickpulse.llm.quality_rules import keep_good, train_field
from clickpulse.llm.queries import vocabulary, word_pattern
from clickpulse.llm.secret_scan import redact
from clickpulse.llm.simhash import one_per_group


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs, train_field(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_per_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return redact(docs, vocabulary("byte_bpe_50k.tiktoken"), word_pattern())


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("secret_scan", secrets), ("packing", packing)]

#: Trained labels, components and token ids have no SQL form; the tests
#: compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        remove(before)  # of the input table nothing is ours to delete
    return docs
