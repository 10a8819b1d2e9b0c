"""A corpus pipeline: quality, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written
as Parquet and read again as the next one's ``docs``. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import minhash, packing, quality, secrets
from siltworks.llm.queries import TOKENIZER
from siltworks.llm.shared import keep, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores 0.5 or more; rows without an id are scored by their text too."""
    source = docs.select(*COLUMNS)
    model = quality.train(source.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), table(spark, sf_dir, "labels"))
    return quality.filter_rows(source, model)


def one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8, the smallest doc_id (null last).

    Rows are told apart by a hash of doc_id and text, so rows without an id or with
    a repeated one are documents like others; rows that are equal in both are one.
    Rows whose hashes meet by chance are all kept.
    """
    rows = docs.select(*COLUMNS).withColumn("__row", F.xxhash64("doc_id", "text"))
    found = minhash.near_duplicates(rows, id_col="__row").select(F.col("doc_id").alias("__row"), "component_id").distinct()
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row")).alias("first")
    kept = rows.select("__row", "doc_id").join(found, "__row").groupBy("component_id").agg(first).select("first.__row")
    matched = rows.join(kept, "__row", "left_semi").withColumn("__text", F.xxhash64("text", F.lit(1)))
    return matched.dropDuplicates(["__row", "doc_id", "__text"]).select(*COLUMNS)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced."""
    return secrets.redact(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in token sequences."""
    return packing.pack(docs, TOKENIZER)


STAGES = [("quality", keep_good), ("near_duplicates", one_of_near_duplicates), ("secrets", without_secrets), ("packing", packed)]

#: SQL cannot express the stages; tests/llm holds them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = keep(docs, f"stage-{name}")
    return docs
