"""Helpers that several operators of this subpackage use.

* :func:`keep` writes an intermediate table to the folder the cluster shares and
  reads it back, which cuts lineage and survives lost executors.
* :func:`components` finds connected components with joins and aggregations only.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where it is unset and Spark runs in one process (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="siltworks-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/siltworks/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back._kept_at = path
    return back


def drop_kept(df: DataFrame) -> None:
    """Delete the files of a table that :func:`keep` wrote and nothing reads any more."""
    path = getattr(df, "_kept_at", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an edge list, as rows (id, component).

    ``component`` is the smallest id that links reach. Ids without an edge to
    another id are absent. Alternates large-star and small-star steps (each a
    grouped minimum and a join) until the edges no longer change; every step is
    a table in the shared folder. Rows with a null end are ignored.
    """
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    now, seen = keep(pairs, "edges"), None
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        seen = mark
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        )
        after = keep(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        drop_kept(now)
        now = after


def stars(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For links between positions below ``n``: each position's smallest reachable one."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[left], label[right])
        after = label.copy()
        np.minimum.at(after, left, low)
        np.minimum.at(after, right, low)
        after = after[after]
        if np.array_equal(after, label):
            return label
        label = after
