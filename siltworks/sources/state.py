"""State tables: versions in folders, and a pointer that names the current one.

A commit writes a new folder and then a marker with the next number. Two writers
that start from one version cannot both commit: a marker is written whole under
another name and then renamed, which fails if the number is taken. A writer that
is lost at any point leaves files that no marker names, which changes nothing.
"""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; a temporary one only where it is unset and Spark runs in one process."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="siltworks-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class CommitConflict(RuntimeError):
    """Another writer committed first."""


class StateTable:
    """A keyed table with optimistic commits."""

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str]):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.schema = spark.createDataFrame([], schema).schema
        self.fs = spark._jvm.org.apache.hadoop.fs.Path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def version(self) -> int:
        """The number of the last commit, 0 before the first."""
        folder = self._path("commits")
        if not self.fs.exists(folder):
            return 0
        return max((int(s.getPath().getName()) for s in self.fs.listStatus(folder) if s.getPath().getName().isdigit()), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        version = self.version() if version is None else version
        if not version:
            return self.spark.createDataFrame([], self.schema)
        name = self.spark.read.text(f"{self.path}/commits/{version}").first()[0]
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/data/{name}")

    def commit(self, df: DataFrame, expected: int) -> int:
        """Make ``df`` the next version if the current one is still ``expected``."""
        name = uuid.uuid4().hex
        df.select(*self.schema.fieldNames()).write.parquet(f"{self.path}/data/{name}")
        if self.version() != expected:
            raise CommitConflict(f"version {expected} is not current")
        written, marker = self._path(f"commits/_{name}"), self._path(f"commits/{expected + 1}")
        stream = self.fs.create(written, False)
        stream.write(name.encode())
        stream.close()
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        never_replace = self.spark._sc._gateway.new_array(hadoop.Options.Rename, 1)
        never_replace[0] = hadoop.Options.Rename.NONE
        try:
            hadoop.FileContext.getFileContext(marker.toUri(), self.spark._jsc.hadoopConfiguration()).rename(written, marker, never_replace)
        except Py4JJavaError as e:
            raise CommitConflict(f"version {expected + 1} is taken") from e
        return expected + 1

    def upsert(self, rows: DataFrame) -> int:
        """Rows in place of those of equal keys; nothing is written if nothing changes."""
        current, state = self.version(), self.read()
        joined = rows.select(*self.schema.fieldNames())
        same = state.intersect(joined)
        if current and joined.exceptAll(same).isEmpty():
            return current
        return self.commit(state.join(joined.select(*self.keys), self.keys, "left_anti").unionByName(joined), current)

    def insert_new(self, rows: DataFrame) -> int:
        current, state = self.version(), self.read()
        fresh = rows.select(*self.schema.fieldNames()).dropDuplicates(self.keys).join(state.select(*self.keys), self.keys, "left_anti")
        return current if current and fresh.isEmpty() else self.commit(state.unionByName(fresh), current)

    def delete(self, keys: DataFrame) -> int:
        current = self.version()
        return self.commit(self.read().join(keys.select(*self.keys).distinct(), self.keys, "left_anti"), current)


def recover_intents(intents: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """Outcome of writes that may have been lost: verified, retry, or held where the target shows something else."""
    seen = observed.select(F.col(key), F.col("version").alias("__seen")).withColumn("__here", F.lit(True))
    outcome = F.when(F.col("__seen").eqNullSafe(F.col("version")), "verified").when(F.col("__here").isNull() | F.col("__seen").eqNullSafe(F.col("before")), "retry").otherwise("held")
    return intents.join(seen, key, "left").withColumn("outcome", outcome).drop("__seen", "__here")


def kept(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends here."""
    path = f"{shared_root(df.sparkSession)}/siltworks/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back._kept_at = path
    return back


def forget(df: DataFrame) -> None:
    """Delete the files of a table that :func:`kept` wrote and nothing reads any more."""
    path = getattr(df, "_kept_at", None)
    if path:
        target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)
