"""A scan in bounded runs as a streaming data source: its offset is where the rotation stands.

Pages are Parquet files, or folders of them, under one path. A run reads the newest
pages, some that were partial before, and pages after a cursor that goes round, as
many as its budget of rows and bytes admits; the next run goes on behind them. The
offset (run, sweep, cursor, pages to try again, pages of this run) is in Spark's
checkpoint, so a run that is lost is read again as it was planned, and executors
read the pages, one a task. A page that cannot be read gives a row with ``problem``
and comes again in later runs, in turn with others of its kind.
"""

from __future__ import annotations

import json
import os.path
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Columns that the source adds to those of the pages.
ADDED = "page string, run long, problem string"


def filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def page_files(path: str) -> dict[str, list[tuple[str, int]]]:
    """Page -> its files and their sizes, by listing; a page is a folder, or a file that stands alone."""
    from pyarrow import fs

    system, root = filesystem(path)
    pages: dict[str, list[tuple[str, int]]] = {}
    for info in system.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)):
        name = os.path.relpath(info.path, root)
        if info.type == fs.FileType.File and not any(x.startswith(("_", ".")) for x in name.split("/")):
            pages.setdefault(os.path.dirname(name) or name, []).append((info.path, info.size))
    return pages


def plan_run(after: dict, pages: dict[str, list], partial: list[str], rows_of, rows: int, size: int, newest: int, retries: int) -> dict:
    """The offset of the next run: what it admits, and where the rotation stands after it.

    The newest pages come first, then ``retries`` of the partial ones, then the pages
    behind the cursor. The first page behind the cursor is always admitted, so each
    page is met within as many runs as there are pages, whatever the budget.
    """
    names = sorted(pages)
    known = set(names)
    waiting = [p for p in after["retry"] if p in known and p in partial]
    waiting += sorted(p for p in partial if p in known and p not in waiting)
    again = waiting[:retries]
    taken, left_rows, left_size = [], rows, size

    def admit(name: str, always: bool = False) -> bool:
        nonlocal left_rows, left_size
        if name in taken:
            return True
        n, b = rows_of(pages[name]), sum(s for _, s in pages[name])
        if not always and (n > left_rows or b > left_size):
            return False
        taken.append(name)
        left_rows, left_size = left_rows - n, left_size - b
        return True

    behind = [p for p in names if p > after["cursor"]]
    order = behind + [p for p in names if p <= after["cursor"]]
    fresh = [p for p in reversed(names)][:newest]
    # room for the rotation is kept before anything else is admitted
    if order:
        admit(order[0], always=True)
    for name in fresh + again:
        admit(name)
    cursor, sweep = after["cursor"], after["sweep"]
    for i, name in enumerate(order):
        if not admit(name):
            break
        sweep += i == len(behind) and after["run"] > 0
        cursor = name
    retried = [p for p in again if p in taken]
    return {"run": after["run"] + 1, "sweep": sweep, "cursor": cursor, "retry": [p for p in waiting if p not in retried] + retried, "pages": taken}


START = {"run": 0, "sweep": 0, "cursor": "", "retry": [], "pages": []}


class Page(InputPartition):
    def __init__(self, name: str, files: list[str], run: int):
        self.name, self.files, self.run = name, files, run


class BudgetedReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: StructType):
        self.options, self.columns = options, [f.name for f in schema.fields][:-3]
        self.planned: dict | None = None
        from pyspark.sql.pandas.types import to_arrow_schema

        self.arrow = to_arrow_schema(schema)

    def initialOffset(self) -> dict:  # noqa: N802
        return START

    def rows_of(self, files: list[tuple[str, int]]) -> int:
        """Rows by the files' footers; of a damaged page none is known."""
        import pyarrow as pa
        import pyarrow.parquet as pq

        system, _ = filesystem(self.options["path"])
        try:
            return sum(pq.read_metadata(f, filesystem=system).num_rows for f, _ in files)
        except (OSError, pa.ArrowInvalid):
            return 0

    def latestOffset(self) -> dict:  # noqa: N802
        if self.planned is None:
            o, pages = self.options, page_files(self.options["path"])
            after = json.loads(o["after"])
            limits = (int(o[k]) for k in ("rows", "bytes", "newest", "retries"))
            self.planned = plan_run(after, pages, json.loads(o["partial"]), self.rows_of, *limits) if pages else after
        return self.planned

    def partitions(self, start: dict, end: dict) -> list[Page]:
        pages = page_files(self.options["path"])
        return [Page(name, [f for f, _ in pages.get(name, [])], end["run"]) for name in end["pages"]]

    def read(self, partition: Page) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq

        system, _ = filesystem(self.options["path"])
        fixed = lambda n, problem: [pa.array([v] * n, t) for v, t in ((partition.name, pa.string()), (partition.run, pa.int64()), (problem, pa.string()))]
        try:
            if not partition.files:
                raise FileNotFoundError(partition.name)
            # all footers first, so that a page with a damaged file gives no rows at all
            files = [pq.ParquetFile(f, filesystem=system) for f in partition.files]
        except (OSError, pa.ArrowInvalid) as e:
            empty = [pa.nulls(1, self.arrow.field(c).type) for c in self.columns]
            yield pa.RecordBatch.from_arrays([*empty, *fixed(1, type(e).__name__)], schema=self.arrow)
            return
        for f in files:
            for b in f.iter_batches(columns=self.columns):
                own = [b.column(c).cast(self.arrow.field(c).type) for c in self.columns]
                yield pa.RecordBatch.from_arrays([*own, *fixed(b.num_rows, None)], schema=self.arrow)

    def commit(self, end: dict) -> None:
        """Nothing to do: the offset is in the checkpoint."""

    def stop(self) -> None:
        """Nothing is held open."""


class BudgetedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "budgeted"

    def streamReader(self, schema: StructType) -> BudgetedReader:  # noqa: N802
        return BudgetedReader(dict(self.options), schema)


def last_offset(spark: SparkSession, checkpoint: str) -> dict:
    """The offset of the last run that was planned, from the checkpoint."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    folder = hadoop.Path(f"{checkpoint}/offsets")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    runs = [int(s.getPath().getName()) for s in system.listStatus(folder) if s.getPath().getName().isdigit()] if system.exists(folder) else []
    if not runs:
        return START
    lines = spark.read.text(f"{checkpoint}/offsets/{max(runs)}", wholetext=True).first()[0].strip().split("\n")
    return json.loads(lines[-1])


def partial_pages(out: DataFrame) -> DataFrame:
    """Rows (page): those whose newest run had a problem."""
    last = out.groupBy("page").agg(F.max_by("problem", F.struct("run", F.col("problem").isNotNull())).alias("problem"))
    return last.where("problem is not null").select("page")


def run_budgeted(spark: SparkSession, path: str, schema: str, out: str, checkpoint: str, rows: int, size: int = 1 << 40, newest: int = 0, retries: int = 1) -> dict:
    """One run: read what the budget admits and add it to the Parquet table ``out``; returns the offset after it.

    ``schema`` names the columns of the pages. The number of partial pages that go
    into the plan is bounded by what runs have admitted.
    """
    spark.dataSource.register(BudgetedSource)
    whole = f"{schema}, {ADDED}"
    after = last_offset(spark, checkpoint)
    partial = [r.page for r in partial_pages(spark.read.schema(whole).parquet(out)).collect()] if after["run"] else []
    given = {"path": path, "after": json.dumps(after), "partial": json.dumps(partial), "rows": rows, "bytes": size, "newest": newest, "retries": retries}
    stream = spark.readStream.format("budgeted").schema(whole).options(**{k: str(v) for k, v in given.items()}).load()
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return last_offset(spark, checkpoint)
