"""Shared storage for intermediate tables and binary files.

Everything that one task writes and another reads lies under the folder that the session names in
``spark.checkpoint.dir``; only a session without that setting (as in tests) gets a folder of its own. Tables go
through Spark's writers. Binary files are written under a name of their own per attempt, and are reachable only
through a manifest table that Spark commits, so that a lost or repeated task never leaves a half file in use.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The session's shared folder; set only where none is set."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if not base and not current and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("a cluster needs spark.checkpoint.dir: executors don't share the driver's folders")
    if not base:
        base = current or f"file://{tempfile.mkdtemp(prefix='paperloom-')}"
        spark.conf.set("spark.checkpoint.dir", base)
    if current is None:
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/paperloom/{name}-{uuid.uuid4().hex}"


def staged_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written to the shared folder and read back, and where it lies."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later plans start there, and lost executors lose nothing."""
    return staged_at(df, name)[0]


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a path; nothing may read it any more."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def bucketed(df: DataFrame, name: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """``df`` as a table dealt by its keys into as many buckets as a shuffle has partitions, a sorted file in each.

    The first frame is for joins on these keys, which read it without a shuffle; the second reads the same files as a
    plain table, for all else (unions of bucketed tables aren't partitioned as Spark 4.1 believes). The files lie in
    the shared folder; the catalog knows the table no longer than it takes to open it.
    """
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"paperloom_{uuid.uuid4().hex}"
    path = fresh_path(spark, name)
    df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    opened = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # external: the files stay
    return opened, spark.read.schema(opened.schema).parquet(path)


#: Bytes of one batch of rows between the JVM and Python; long texts make batches of fewer rows.
BATCH_BYTES = 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Batches to Python are bounded in bytes from now on, where the session sets no bound of its own."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def in_arrow(df: DataFrame, function, schema) -> DataFrame:
    """``df.mapInArrow`` with batches that are bounded in bytes."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(function, schema)


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def smallest_hashes(rows: DataFrame, key: str, most: int, n: int) -> DataFrame:
    """At most ``most`` of ``n`` rows, those whose keys have the smallest hashes.

    A bound on the hash leaves about one and a half times as many first, so that tasks never send more than these few
    rows to the one that sorts them, however many tasks there are.
    """
    share = 1.5 * most / n if n else 1.0
    kept = rows if share >= 1 else rows.filter(F.xxhash64(key) <= F.lit(int(-(1 << 63) + share * (1 << 64))))
    return kept.orderBy(F.xxhash64(key), key).limit(most)


def _split(uri: str):
    """(filesystem or None for a local path, path)."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return None, unquote(parsed.path)
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def open_new(uri: str):
    """A writable binary file; its folder is made first."""
    files, path = _split(uri)
    if files is None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        return open(path, "wb")
    files.create_dir(os.path.dirname(path), recursive=True)
    return files.open_output_stream(path)


def publish(written: str, uri: str) -> None:
    """Gives a finished file its name in one step. A file that has it already, from an earlier attempt, is the same."""
    files, path = _split(uri)
    source = _split(written)[1]
    if files is None:
        os.replace(source, path)
    elif files.get_file_info(path).type.name == "NotFound":
        files.move(source, path)
    else:
        files.delete_file(source)


def open_at(uri: str):
    """A readable, seekable binary file."""
    files, path = _split(uri)
    return open(path, "rb") if files is None else files.open_input_file(path)


def read_all(uri: str) -> bytes:
    with open_at(uri) as f:
        return f.read()


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def discard(spark: SparkSession) -> None:
    """Deletes everything that this package keeps in the shared folder; results that still read it must be written first."""
    delete(spark, f"{shared_dir(spark)}/paperloom")
