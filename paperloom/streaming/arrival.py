"""Documents as they arrive: a stream of files runs through the same stages, batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.identity import canonical_json, stable_id
from ..plans import ingest

FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def arriving(spark: SparkSession, folder: str) -> DataFrame:
    """A stream of artifact rows from a folder that files are moved into."""
    files = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", "true").load(folder)
    name, digest = F.element_at(F.split("path", "/"), -1), F.sha2("content", 256)
    artifact = stable_id("artifact", canonical_json(display_name=name, path=F.col("path")))
    document = stable_id("document", canonical_json(role=F.lit("primary"), sha256=digest))
    return files.select(artifact.alias("artifact_id"), document.alias("document_id"), name.alias("display_name"), digest.alias("sha256"), F.col("length").alias("size_bytes"), "content")


def ingest_stream(spark: SparkSession, folder: str, root: str, checkpoint: str, policy: ingest.Policy = ingest.Policy(), tables: tuple[str, ...] = ("documents", "native_units", "statuses")) -> StreamingQuery:
    """Appends the named tables for every batch of new files; a batch that is run again replaces its own partition."""

    def run(batch: DataFrame, number: int) -> None:
        batch.persist()
        found = ingest.plan(batch, policy, until=max(tables, key=[n for n, _ in ingest.STAGES].index))
        for name in tables:
            found[name].write.mode("overwrite").parquet(f"{root}/{name}/batch={number}")
        batch.unpersist()

    return arriving(spark, folder).writeStream.foreachBatch(run).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts per window and type of a stream with a ``ts`` column; later events than ``late`` are left out."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
