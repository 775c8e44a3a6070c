"""Shared working folder, written tables, and shipping of this package to the executors.

Everything that must outlive a stage is a Parquet table below ``spark.checkpoint.dir``, so a lost
executor costs a re-read, never a recomputation from a copy that is gone.
"""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a temporary one only where a local session names none (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not (spark.sparkContext.master or "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="atelier-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: Rows of an Arrow batch, where the session has Spark's own default: whole texts come in a batch, and a batch is held on both sides.
BATCH_ROWS = "1000"


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per Spark context."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    if getattr(sc, "_atelier_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    held = io.BytesIO()
    with zipfile.ZipFile(held, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    path = os.path.join(tempfile.mkdtemp(prefix="atelier-ship-"), "atelier_pkg.zip")
    Path(path).write_bytes(held.getvalue())
    sc.addPyFile(path)
    sc._atelier_shipped = True


class Scratch:
    """Tables of one run, in one folder below the shared one."""

    def __init__(self, spark: SparkSession, name: str):
        ship(spark)
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: a cut of the lineage that survives executors."""
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        remove(self.spark, f"{self.root}/{name}")

    def sweep(self, *keep: str) -> None:
        """Remove all tables of the run but those that its result still reads."""
        fs, at = hadoop(self.spark, self.root)
        for s in fs.listStatus(at) if fs.exists(at) else []:
            if s.getPath().getName() not in keep:
                fs.delete(s.getPath(), True)


def schema_with(df: DataFrame, **more: str) -> T.StructType:
    """Schema of ``df`` with further columns; anything may be null."""
    own = [T.StructField(f.name, f.dataType, True) for f in df.schema.fields]
    return T.StructType(own + [T.StructField(k, T.DataType.fromDDL(v), True) for k, v in more.items()])


def hadoop(spark: SparkSession, path: str):
    """(file system, path object) of Hadoop's API, which reaches every store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = hadoop(spark, path)
    return fs.exists(at)


def remove(spark: SparkSession, path: str) -> None:
    fs, at = hadoop(spark, path)
    fs.delete(at, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
