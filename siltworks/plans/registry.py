"""The registry that the entry module reads."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL that must give the same rows."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Two snapshots of one collection, derived from documents: rows and texts differ by fixed rules.
PRIOR_SQL = "SELECT doc_id, source, lang, CASE WHEN doc_id % 7 = 0 THEN text || ' v1' ELSE text END AS body FROM documents WHERE doc_id % 10 <> 0"
CURRENT_SQL = "SELECT doc_id, source, lang, text AS body FROM documents WHERE doc_id % 11 <> 0"


def snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", F.col("text").alias("body"))
    prior = docs.where("doc_id % 10 <> 0").withColumn("body", F.when(F.col("doc_id") % 7 == 0, F.concat("body", F.lit(" v1"))).otherwise(F.col("body")))
    return prior, docs.where("doc_id % 11 <> 0")
