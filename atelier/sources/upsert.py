"""Tables that change by key: touched partitions alone are written anew, and a commit makes them the table.

A table is a folder of commits and a folder for each write.  A commit names, for every partition that has rows, the
folder that holds it, so a reader sees one commit whole, and a job that ends between two steps leaves the last commit
as it was: what it had written is named by no commit.  Nothing needs to be put right after a crash; ``tidy`` deletes
what no commit names.

A commit is put in place by a rename that must not replace anything.  HDFS refuses such a rename, so that of two
writers one fails and may start again; on stores where a rename replaces, one writer at a time is allowed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

BUCKET = "_bucket"


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def _names(spark: SparkSession, path: str) -> list[str]:
    at, fs = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def commits(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the commits, in order."""
    return [int(n[:-5]) for n in _names(spark, f"{path}/_commits") if n.endswith(".json")]


def commit(spark: SparkSession, path: str, number: int | None = None) -> dict | None:
    """A commit, the last one unless ``number`` names it; None where there is none."""
    known = commits(spark, path)
    if not known:
        return None
    at = f"{path}/_commits/{known[-1] if number is None else number:020d}.json"
    return json.loads(spark.read.option("wholetext", True).text(at).first()[0])


def read(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as one commit has it."""
    found = commit(spark, path, number)
    if found is None:
        raise FileNotFoundError(f"{path} has no commit")
    return _rows(spark, path, found, found["folders"])


def _rows(spark: SparkSession, path: str, found: dict, buckets) -> DataFrame:
    folders = [f"{path}/{found['folders'][k]}" for k in sorted(buckets, key=int) if k in found["folders"]]
    schema = StructType.fromJson(found["schema"])
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def upsert(changes: DataFrame, path: str, keys: list[str], order: list | None = None, deleted: str | None = None, buckets: int = 256, batch: tuple[str, int] | None = None) -> int:
    """Rows of ``changes`` take the place of rows with equal keys, others are added; returns the number of the commit.

    Keys are equal null-safely.  Of several changes of a key the last by ``order`` counts (without an order they must
    be one a key, else an error is raised); where the column ``deleted`` is true, the key's row goes.  ``deleted`` is
    no column of the table.  ``batch`` (writer, number): a number that is not above the writer's last is left out, so a
    batch that is played again changes nothing.  ``buckets``, the number of partitions by a hash of the keys, is
    decided by the first commit.
    """
    spark = changes.sparkSession
    last = commit(spark, path)
    done = dict(last["batches"]) if last else {}
    if batch and batch[1] <= done.get(batch[0], -1):
        return last["number"]
    columns = [x for x in changes.columns if x != deleted]
    schema = last["schema"] if last else json.loads(changes.select(*columns).schema.json())
    if last and (last["keys"] != keys or last["columns"] != columns):
        raise ValueError(f"{path} has keys {last['keys']} and columns {last['columns']}")
    buckets = last["buckets"] if last else buckets
    number = last["number"] + 1 if last else 0
    folder = f"rows-{uuid.uuid4().hex}"
    of_key = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    each = Window.partitionBy(BUCKET, *keys)
    new = changes.withColumn(BUCKET, of_key).withColumn("_gone", F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False))
    if order:
        new = new.withColumn("_n", F.row_number().over(each.orderBy(*(F.desc(x) if isinstance(x, str) else x for x in order)))).filter("_n = 1")
    else:
        new = new.withColumn("_n", F.count("*").over(each)).withColumn("_n", F.when(F.col("_n") > 1, F.raise_error(F.lit("several changes of a key and no order"))).otherwise(F.lit(1))).filter("_n = 1")
    new = new.select(*columns, BUCKET, "_gone")
    # at most as many rows as there are partitions
    touched = [str(r[0]) for r in changes.select(of_key.alias("b")).distinct().collect()]
    if last:
        types = {f.name: f.dataType for f in StructType.fromJson(schema)}
        old = _rows(spark, path, last, touched).withColumn(BUCKET, of_key)
        same = [F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}")) for k in [BUCKET, *keys]]
        kept = old.alias("o").join(new.select(BUCKET, *keys).alias("n"), same, "left_anti").select(*columns, BUCKET)
        rows = kept.unionByName(new.filter("not _gone").select(*(F.col(k).cast(types[k]).alias(k) for k in columns), BUCKET))
    else:
        rows = new.filter("not _gone").drop("_gone")
    rows.repartition(BUCKET).write.partitionBy(BUCKET).parquet(f"{path}/{folder}")
    written = {n.split("=")[1]: f"{folder}/{n}" for n in _names(spark, f"{path}/{folder}") if n.startswith(f"{BUCKET}=")}
    kept_folders = {k: v for k, v in (last["folders"] if last else {}).items() if k not in touched}
    if batch:
        done[batch[0]] = batch[1]
    _put(spark, path, {"number": number, "keys": keys, "columns": columns, "schema": schema, "buckets": buckets, "folders": kept_folders | written, "batches": done})
    return number


def _put(spark: SparkSession, path: str, found: dict) -> None:
    """Write a commit beside the others, then give it its name, which must be free."""
    beside, fs = _at(spark, f"{path}/_commits/.{uuid.uuid4().hex}")
    name, _ = _at(spark, f"{path}/_commits/{found['number']:020d}.json")
    out = fs.create(beside, False)
    out.write(bytearray(json.dumps(found), "utf-8"))
    out.close()
    if fs.exists(name) or not fs.rename(beside, name):
        raise FileExistsError(f"{name.toString()} is there: another writer was first")


def tidy(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Drop all but the last ``keep`` commits and the folders that none of these names; returns how many folders went.

    Only while nobody writes: a folder whose commit is still to come is named by none.
    """
    known = commits(spark, path)
    at = lambda n: _at(spark, f"{path}/{n}")
    named = {f for n in known[-keep:] for f in commit(spark, path, n)["folders"].values()}
    for n in known[:-keep]:
        p, fs = at(f"_commits/{n:020d}.json")
        fs.delete(p, False)
    gone = 0
    for folder in _names(spark, path):
        if folder.startswith("rows-"):
            for part in _names(spark, f"{path}/{folder}"):
                if part.startswith(f"{BUCKET}=") and f"{folder}/{part}" not in named:
                    p, fs = at(f"{folder}/{part}")
                    gone += bool(fs.delete(p, True))
    return gone
