"""Intermediate tables in the folder that the session shares among its executors (``spark.checkpoint.dir``).

A session without that setting, as in tests, gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("a cluster needs spark.checkpoint.dir: executors don't share the driver's folders")
        base = f"file://{tempfile.mkdtemp(prefix='paperloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def kept(df: DataFrame, name: str = "stage") -> DataFrame:
    """``df`` written to the shared folder and read back: later plans start there. Tables are mostly ids, which zstd makes
    smaller and snappy doesn't."""
    path = fresh(name, df.sparkSession)
    df.write.parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n) of the keys that several of these rows share.

    Hashes are counted first, and keys are shuffled only if a hash comes twice: elsewhere eight bytes a row move, not
    its keys. ``rows`` are read twice.
    """
    own = F.xxhash64(*keys).alias("__hash")
    twice = kept(rows.groupBy(own).agg(F.count("*").alias("n")).filter("n > 1").select("__hash"), "repeated-hashes")
    found = rows.select(*keys, own)
    found = found.limit(0) if twice.isEmpty() else found.join(twice, "__hash", "left_semi")
    return found.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def fresh(name: str, spark: SparkSession) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/paperloom/{name}-{uuid.uuid4().hex}"


def write_ordered(df: DataFrame, path: str, keys: list[str], n_files: int | None = None) -> None:
    """Writes ``df`` in global order of ``keys`` (nulls last) below ``path``, with a manifest of its files.

    Range partitions are sorted and written, one or more files each; ``files`` then says of every file its rank in this
    order, the number of rows before it, its rows and its first and last key (the zone map). Keys that many rows share
    may run over several files. Spark chooses the number of files by their sizes unless it is given. The manifest is written last: a folder without it is no catalog.
    """
    order = [F.col(f"`{k}`").asc_nulls_last() for k in keys]
    spark = df.sparkSession
    # a row's place in its partition is written with it, so that order doesn't depend on how files are read back
    ranged = df.repartitionByRange(*([n_files] if n_files else []), *order).sortWithinPartitions(*order)
    ranged.withColumn("__place", F.monotonically_increasing_id()).write.parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    key = F.struct(*[F.struct(F.col(f"`{k}`").isNull().alias("none"), F.col(f"`{k}`").alias("key")).alias(f"k{i}") for i, k in enumerate(keys)])
    found = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.min("__place").alias("start"), F.count("*").alias("n"), F.min(key).alias("first"), F.max(key).alias("last"))
    in_order = Window.orderBy("start")  # one row per file
    before = F.coalesce(F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")
    listed = found.select((F.row_number().over(in_order) - 1).alias("rank"), "file", before.alias("before"), "start", "n", "first", "last")
    listed.coalesce(1).write.parquet(f"{path}/files")


def read_ordered(spark: SparkSession, path: str, place: str | None = None) -> DataFrame:
    """The rows of ``write_ordered``; with ``place`` also each row's number in the global order."""
    files = spark.read.parquet(f"{path}/files")
    rows = spark.read.parquet(f"{path}/rows")
    if place is None:
        return rows.drop("__place")
    starts = F.broadcast(files.select("file", "before", "start"))  # one row per file
    joined = rows.withColumn("file", F.col("_metadata.file_name")).join(starts, "file")
    return joined.withColumn(place, F.col("before") + F.col("__place") - F.col("start")).drop("file", "before", "start", "__place")


def lookup(spark: SparkSession, path: str, **key) -> DataFrame:
    """The rows with these values of the leading keys; only files whose zone may hold them are opened."""
    files = spark.read.parquet(f"{path}/files")
    parts = lambda c: F.struct(*[F.col(f"{c}.k{i}.none").alias(f"n{i}") if j == 0 else F.col(f"{c}.k{i}.key").alias(f"v{i}") for i in range(len(key)) for j in (0, 1)])
    wanted = F.struct(*[F.lit(v is None).alias(f"n{i}") if j == 0 else F.lit(v).cast(files.schema["first"].dataType[i].dataType["key"].dataType).alias(f"v{i}") for i, v in enumerate(key.values()) for j in (0, 1)])
    names = [r.file for r in files.filter((parts("first") <= wanted) & (parts("last") >= wanted)).select("file").collect()]
    rows = spark.read.schema(spark.read.parquet(f"{path}/rows").schema).parquet(*[f"{path}/rows/{n}" for n in names]) if names else spark.read.parquet(f"{path}/rows").limit(0)
    for k, v in key.items():
        rows = rows.filter(F.col(f"`{k}`").eqNullSafe(F.lit(v)))
    return rows.drop("__place")


def promoted(df: DataFrame, path: str) -> None:
    """Writes ``df`` beside ``path`` and gives it that name in one step; what was there before comes back if that fails."""
    spark = df.sparkSession
    staging, backup = f"{path}.new-{uuid.uuid4().hex}", f"{path}.old-{uuid.uuid4().hex}"
    df.write.parquet(staging)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    target = hadoop(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    had = files.exists(target)
    if had and not files.rename(target, hadoop(backup)):
        raise OSError(f"{path} can't be set aside")
    if not files.rename(hadoop(staging), target):
        if had:
            files.rename(hadoop(backup), target)
        raise OSError(f"{path} can't be replaced")
    if had:
        files.delete(hadoop(backup), True)
