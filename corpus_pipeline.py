"""The corpus pipeline: documents in, packed training sequences out.

Each stage works on everything its predecessor kept, stored as Parquet in between. All stages but
the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm import langid
from sensorloom.llm.common import stored, table
from sensorloom.llm.decontaminate import without_contaminated
from sensorloom.llm.minhash import near_duplicates
from sensorloom.llm.packing import pack
from sensorloom.llm.pii import replace_entities


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that the language model rejects; it learns from all labelled rows of ``docs``."""
    model = langid.fit(docs, "doc_id", "text", "lang")
    judged = langid.predict(docs, model, results=("stage lang", "stage score", "stage rejected"))
    return judged.where("not `stage rejected`").select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, the one with the least id. They share
    80 percent or more of their five-word shingles.

    Rows of one id stay or go together; a null id stays.
    """
    kept = near_duplicates(docs, threshold=80).where("kept").select("doc_id").distinct()
    with_id = docs.where("doc_id is not null").join(kept, "doc_id", "left_semi")
    return with_id.unionByName(docs.where("doc_id is null"))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold an item of ``benchmark``."""
    return without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by surrogates; n_chars follows the new text."""
    replaced = replace_entities(docs, count_col="stage entities").drop("stage entities")
    return replaced.withColumn("n_chars", F.length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs all texts into sequences of 1024 tokens; returns the pieces with their ids."""
    return pack(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("personal_data", personal_data_stage),
    ("packing", packing_stage),
]

# Tokenization, signatures and surrogates have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
