"""Line dedup by levelled sorted runs of line hashes.

A run is a table of (line hash, documents holding the line, largest document), dealt by hash into buckets and sorted
in each, so that Spark merges it with others without shuffling or searching. Batches of documents come in descending
order of ``doc_id``. A batch's line hashes are aggregated, merge-anti-joined with the keys that the runs have settled
(held by ``min_documents`` or more already: later batches can change neither their fate nor the document that keeps
them), and the rest becomes a run of level 0. When a level holds ``FANOUT`` runs, they are merged into one run of the
next level, which later batches meet. After the last batch, the merged runs say which lines go.

Only DataFrame functions are used. A line is known by a 128-bit hash. Hot lines are pre-aggregated per task, and the
lines that must go are found by a join whose large partitions Spark splits; the lists that are collected hold the
positions of one document's lines.

Nulls and odd rows: a null or empty text is one empty line. Rows are documents: rows of equal ``doc_id`` each count,
and all those of the largest id keep the line. Rows of null ``doc_id`` count and never keep a line that a row with an
id holds. An empty table gives no rows. Extra columns pass through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage

WHITE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH = 20
MIN_DOCUMENTS = 3
#: Documents of a batch; a table is dealt into LEAST_BATCHES batches at least, so that compacted runs meet batches.
BATCH_DOCUMENTS = 50_000_000
LEAST_BATCHES = 6
#: Runs of a level that are merged into one.
FANOUT = 4


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lower-cased."""
    bare = F.btrim(line, F.lit(WHITE))
    ascii_only = F.length(bare) == F.octet_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _hashed(key: Column) -> Column:
    return F.struct(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"))


def line_hashes(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, row_hash, hashes): per document and line the hash of its key, null for a key that is too short."""
    text = storage.text_or_empty()
    keys = F.transform(F.split(text, "\n", -1), line_key)
    hashes = F.transform(keys, lambda k: F.when(F.length(k) >= min_length, _hashed(k)))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("row_hash"), hashes.alias("hashes"))


class LineRuns:
    """The levels of runs. ``add`` takes ``line_hashes`` of a batch whose ids lie below those of earlier batches."""

    def __init__(self, spark: SparkSession, min_documents: int = MIN_DOCUMENTS, fanout: int = FANOUT):
        self.spark, self.min_documents, self.fanout = spark, min_documents, fanout
        self.levels: list[list[tuple[DataFrame, DataFrame]]] = []  # each run in buckets, and plain

    def _runs(self) -> list[tuple[DataFrame, DataFrame]]:
        return [run for level in self.levels for run in level]

    def _write(self, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        return storage.bucketed(rows, "line-run", ["h1", "h2"])

    @staticmethod
    def _merged(runs: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
        rows = runs[0][1]
        for _, run in runs[1:]:
            rows = rows.unionByName(run)
        return rows.groupBy("h1", "h2").agg(F.sum("n_docs").alias("n_docs"), F.max("last_doc").alias("last_doc"))

    def add(self, hashed: DataFrame) -> None:
        line = F.explode(F.array_distinct(F.filter("hashes", lambda h: h.isNotNull()))).alias("h")
        new = hashed.select("doc_id", line).groupBy("h.h1", "h.h2").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc"))
        for run, _ in self._runs():
            new = new.join(run.filter(F.col("n_docs") >= self.min_documents).select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")
        if not self.levels:
            self.levels.append([])
        self.levels[0].append(self._write(new))
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            self.levels[level + 1].append(self._write(self._merged(self.levels[level])))
            self.levels[level] = []
            level += 1

    def frequent(self) -> DataFrame:
        """(h1, h2, last_doc) of the lines held by enough documents."""
        runs = self._runs()
        rows = runs[0][1] if len(runs) == 1 else self._merged(runs)
        return rows.filter(F.col("n_docs") >= self.min_documents).select("h1", "h2", "last_doc")


def cuts(hashed: DataFrame, n: int | None = None) -> list[int]:
    """The ids that part the documents into n batches of about equal size, descending; n follows their number."""
    if n is None:
        n = max(LEAST_BATCHES, -(-hashed.count() // BATCH_DOCUMENTS))
    found = hashed.select("doc_id").approxQuantile("doc_id", [i / n for i in range(1, n)], 0.02)
    return sorted({int(c) for c in found}, reverse=True)


def batches(hashed: DataFrame, n: int | None = None) -> tuple[DataFrame, list[DataFrame]]:
    """``hashed`` written to the shared folder, and its batches, ids descending; null ids come last.

    A batch has files of its own, so that it reads these alone, however many batches there are.
    """
    ids = cuts(hashed, n)
    number = F.coalesce(F.size(F.filter(F.lit(ids).cast("array<bigint>"), lambda c: F.col("doc_id") <= c)), F.lit(len(ids)))
    path = storage.fresh_path(hashed.sparkSession, "line-hashes")
    rows = hashed.withColumn("batch", F.when(F.col("doc_id").isNull(), len(ids)).otherwise(number))
    rows.repartitionByRange("batch", "doc_id", "row_hash").write.partitionBy("batch").parquet(path)
    whole = hashed.sparkSession.read.schema(rows.schema).parquet(path)
    return whole.drop("batch"), [whole.filter(F.col("batch") == k).drop("batch") for k in range(len(ids) + 1)]


def dedup(docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``docs`` with ``kept_text``, ``n_lines`` (before) and ``n_dropped``; columns of those names are replaced."""
    hashed, parts = batches(line_hashes(docs, min_length))
    runs = LineRuns(docs.sparkSession, min_documents)
    for batch in parts:
        runs.add(batch)
    lines = hashed.select(F.col("doc_id").alias("line_doc"), "row_hash", F.posexplode("hashes").alias("pos", "h")).filter("h IS NOT NULL")
    lines = lines.select("line_doc", "row_hash", "pos", F.col("h.h1").alias("h1"), F.col("h.h2").alias("h2"))
    found = lines.join(runs.frequent(), ["h1", "h2"]).filter(F.col("last_doc").isNotNull() & ~F.col("line_doc").eqNullSafe(F.col("last_doc")))
    dropped = found.groupBy("row_hash", "line_doc").agg(F.collect_set("pos").alias("dropped_lines"))

    own = docs.drop("kept_text", "n_lines", "n_dropped", "row_hash", "line_doc", "dropped_lines")
    hidden = [c for c in docs.columns if c in ("row_hash", "line_doc", "dropped_lines")]
    text = storage.text_or_empty()
    keyed = docs.select(F.xxhash64("doc_id", text).alias("row_hash"), F.col("doc_id").cast("long").alias("line_key"), F.struct(*[F.col(f"`{c}`") for c in [*own.columns, *hidden]]).alias("kept_row"))
    joined = keyed.join(dropped, (keyed.row_hash == dropped.row_hash) & keyed.line_key.eqNullSafe(dropped.line_doc), "left")
    lines = F.split(F.coalesce(F.col("kept_row.text"), F.lit("")), "\n", -1)
    n_lines = F.size(lines).cast("long")
    kept = F.when(F.col("dropped_lines").isNull(), F.coalesce(F.col("kept_row.text"), F.lit(""))).otherwise(
        F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("dropped_lines")), lambda i: F.get(lines, i)), "\n")
    )
    return joined.select(*[F.col(f"kept_row.`{c}`").alias(c) for c in [*own.columns, *hidden]], kept.alias("kept_text"), n_lines.alias("n_lines"), F.coalesce(F.size("dropped_lines"), F.lit(0)).cast("long").alias("n_dropped"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op3: drops the lines of every document that a larger document keeps."""
    out = dedup(storage.documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (SELECT doc_id, pos, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key AS fkey, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT doc_id, pos, line, (keeper IS NOT NULL AND doc_id <> keeper) AS gone FROM k LEFT JOIN f ON fkey = key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
