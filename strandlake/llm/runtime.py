"""What the operators need from a session: the shared folder, batches of bounded size and shipped code."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parents[1]
_shipped: set[str] = set()  # applications that have the package's files
_made: dict[str, list[str]] = {}  # folders of the tables of each application


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset and all runs on one machine (tests), a new temporary
    folder; on a cluster that is an error, as executors would write to disks of their own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="strandlake-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Tables written to the shared folder: they cut lineage and survive lost executors."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.tables: dict[str, str] = {}  # names in the session's catalog
        _made.setdefault(spark.sparkContext.applicationId, []).append(self.root)

    def write(self, df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
        writer = df.write.mode("overwrite")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(f"{self.root}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.root}/{name}")

    def write_sorted(self, df: DataFrame, name: str, keys: tuple[str, ...]) -> DataFrame:
        """A table bucketed and sorted by the keys, in as many buckets as a shuffle has partitions, so that a join on
        the keys moves only its other side."""
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        table = f"{name}_{uuid.uuid4().hex}"
        ready = df.repartition(buckets, *keys)
        ready.write.bucketBy(buckets, *keys).sortBy(*keys).format("parquet").option("path", f"{self.root}/{name}").saveAsTable(table)
        self.tables[name] = table
        return self.spark.table(table)

    def plain(self, name: str, table: DataFrame) -> DataFrame:
        """The files of a table that was written sorted, without its buckets."""
        return self.spark.read.schema(table.schema).parquet(f"{self.root}/{name}")

    def drop(self, name: str = "") -> None:
        """Delete a table that no later step reads (or all of them)."""
        for made in [name] if name else list(self.tables):
            if made in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(made)}")
        _delete(self.spark, f"{self.root}/{name}" if name else self.root)


def clean(spark: SparkSession) -> None:
    """Delete the tables that operators of this session wrote to the shared folder. Results read them, so call it
    when they have been written or collected."""
    for folder in _made.pop(spark.sparkContext.applicationId, []):
        _delete(spark, folder)


@contextmanager
def temporary(spark: SparkSession) -> Iterator[None]:
    """Deletes the tables that operators write inside, at its end; write the results that read them before that."""
    made = _made.setdefault(spark.sparkContext.applicationId, [])
    before = len(made)
    try:
        yield
    finally:
        for folder in made[before:]:
            _delete(spark, folder)
        del made[before:]


def fresh(name: str, taken: list[str]) -> str:
    """A column name that isn't taken."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often it stands in there, in lambda functions, too."""
    return F.transform(F.array(value), use)[0]


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Spark bounds the bytes of a batch; this bounds its rows, so what is made of them stays small, too."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def prepare(spark: SparkSession) -> None:
    """The package goes to the executors where their PYTHONPATH lacks it."""
    home = str(PACKAGE.parent)
    application = spark.sparkContext.applicationId
    if home in os.environ.get("PYTHONPATH", "").split(":") or application in _shipped:
        return
    made = shutil.make_archive(os.path.join(tempfile.mkdtemp(), PACKAGE.name), "zip", home, PACKAGE.name)
    spark.sparkContext.addPyFile(made)
    _shipped.add(application)
