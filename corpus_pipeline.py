"""From raw documents to a training mix, in five stages.

1. quality: documents that the compression classifier rejects go;
2. near_duplicates: of each group of SimHash near-duplicates one document stays;
3. decontaminate: documents that hold a benchmark item, whole or edited, go;
4. pii: personal data in the texts is replaced by its kind;
5. mix: each document with the words that the mix of sources takes of it, its places in
   the output shards (shard, slot, first and past-the-last word) and its text.

A stage gets the session, the documents that the stage before kept and the folder of
the other tables (labels, benchmark). ``run`` writes what a stage returns to the shared
folder and reads it again for the next, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kontor.llm import decontaminate, mixing, pii, quality, simhash
from kontor.llm.common import stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs, words=simhash.SHINGLE_WORDS, distance=simhash.MAX_DISTANCE)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_uncontaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each_group),
    ("decontaminate", keep_uncontaminated),
    ("pii", redact),
    ("mix", mix),
]

# Trained scores, XXH64 fingerprints and alignments have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in turn over the documents of ``sf_dir``; returns the rows of the last.

    Null and empty texts count as good text of no words: the fingerprint stage keeps one of
    them, which the mix takes nothing of. Of equal rows, and of rows of near-equal texts,
    one stays; a null doc_id is a document like others. Without documents there are no rows,
    without labels no document is rejected, without a benchmark none is contaminated.
    """
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
