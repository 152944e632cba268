"""Files in pieces, catalogs in order, hashes of sets."""

import hashlib
import random
import resource

import pytest
from pyspark.sql import functions as F

from paperloom import storage
from paperloom.operators import digests, json_tree
from paperloom.plans import ingest
from paperloom.sources import acquire, chunks


def test_chunks_and_hashes(spark, tmp_path):
    rng = random.Random(1)
    contents = {"a.bin": b"", "b.bin": rng.randbytes(5000), "deep/c d.txt": rng.randbytes(4096), "deep/é.bin": b"x"}
    for name, data in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    got = {}
    for r in chunks.chunks(spark, str(tmp_path), 1024).orderBy("path", "chunk").collect():
        name = r.path.split(f"{tmp_path}/")[1]
        assert r.start == r.chunk * 1024 == len(got.get(name, b"")) and len(r.bytes) <= 1024
        got[name] = got.get(name, b"") + bytes(r.bytes)
    assert got == {k: v for k, v in contents.items() if v}
    want = {(k, len(v), hashlib.sha256(v).hexdigest()) for k, v in contents.items()}
    assert {(r.path.split(f"{tmp_path}/")[1], r.size_bytes, r.sha256) for r in chunks.hashes(spark, f"file://{tmp_path}").collect()} == want
    assert {r.path.rsplit("/", 1)[1] for r in chunks.hashes(spark, str(tmp_path), suffix=".txt").collect()} == {"c d.txt"}
    assert chunks.hashes(spark, str(tmp_path / "b.bin")).count() == 1
    (tmp_path / "none").mkdir()
    assert chunks.chunks(spark, str(tmp_path / "none")).count() == 0


def test_three_gib_file_in_little_memory(spark, tmp_path):
    path, size = tmp_path / "large.bin", 3 << 30
    with open(path, "wb") as f:
        f.truncate(size)  # sparse: three GiB of zeros without the disk
    digest = hashlib.sha256()
    for _ in range(size >> 24):
        digest.update(bytes(1 << 24))
    spark.dataSource.register(chunks.ChunkSource)
    reader = chunks.ChunkReader({"path": str(path), "mode": "hashes"})
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    (batch,) = reader.read(reader.partitions()[0])
    assert batch.to_pylist()[0]["sha256"] == digest.hexdigest()
    assert (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) << 10 < 200 << 20
    assert chunks.hashes(spark, str(path)).first().size_bytes == size


def test_ordered_catalog_and_lookup(spark, tmp_path):
    rng = random.Random(2)
    rows = [(rng.choice([None, "a", "b", "c", "zz"]), rng.randrange(50), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, n long, i long")
    path = str(tmp_path / "catalog")
    storage.write_ordered(df.repartition(6), path, ["k", "n", "i"], 5)
    key = lambda r: (r[0] is None, r[0] or "", r[1], r[2])
    placed = sorted(storage.read_ordered(spark, path, "place").collect(), key=lambda r: r.place)
    assert [r.place for r in placed] == list(range(2000)) and [tuple(r)[:3] for r in placed] == sorted(rows, key=key)
    files = spark.read.parquet(f"{path}/files").orderBy("rank").collect()
    one_by_one = [tuple(r)[:3] for f in files for r in spark.read.parquet(f"{path}/rows/{f.file}").orderBy("__place").collect()]
    assert len(files) > 1 and one_by_one == sorted(rows, key=key)
    for k in ("b", None, "nowhere"):
        found = storage.lookup(spark, path, k=k)
        assert sorted(r.i for r in found.collect()) == sorted(i for a, _, i in rows if a == k)
    exact = storage.lookup(spark, path, k="a", n=7)
    assert sorted(r.i for r in exact.collect()) == sorted(i for a, n, i in rows if (a, n) == ("a", 7)) and len(exact.inputFiles()) <= 2
    storage.write_ordered(df.limit(0), str(tmp_path / "empty"), ["k"])
    assert storage.read_ordered(spark, str(tmp_path / "empty"), "place").count() == 0 and storage.lookup(spark, str(tmp_path / "empty"), k="a").count() == 0


def tree(leaves, fanout):
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    level = list(leaves)
    while len(level) > 1:
        level = [sha("".join(d + "\n" for d in level[i : i + fanout])) for i in range(0, len(level), fanout)]
    return sha(f"{len(leaves)}:{level[0]}")


def test_set_hashes(spark):
    rng = random.Random(3)
    rows = [(g, i, f"{rng.getrandbits(32):x}") for g, n in ((None, 300), ("a", 1), ("b", 3), ("c", 4), ("d", 16), ("e", 17), ("f", 65)) for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i long, h string")
    want = {g: (sum(x[0] == g for x in rows), tree([h for _, h in sorted((i, h) for x, i, h in rows if x == g)], 4)) for g in {x[0] for x in rows}}
    for frame in (df, df.repartition(7, "h")):
        assert {r.g: (r.n, r.root) for r in digests.roots(frame, ["g"], ["i"], F.col("h"), 4).collect()} == want
    whole = digests.roots(df, [], ["g", "i"], F.col("h"), 5).collect()
    order = [h for _, _, _, h in sorted((g is None, g or "", i, h) for g, i, h in rows)]
    assert [(r.n, r.root) for r in whole] == [(len(rows), tree(order, 5))]
    assert digests.roots(df.limit(0), ["g"], ["i"], F.col("h")).count() == 0
    with pytest.raises(ValueError):
        digests.roots(df, ["g"], ["i"], F.col("h"), 1)


def test_another_source_is_not_resumed(spark, tmp_path):
    one, two = acquire.injected(spark, {"a": b"first"}), acquire.injected(spark, {"b": b"second", "c": b"third"})
    for source, n in ((one, 1), (two, 2), (one, 1)):
        assert ingest.write(spark, source, str(tmp_path / "out"), until="documents")["documents"].count() == n
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "x.txt").write_text("old")
    before = ingest.write(spark, str(folder), str(tmp_path / "out"), until="documents")["artifacts"].first().sha256
    (folder / "x.txt").write_text("new")
    tables = ingest.write(spark, str(folder), str(tmp_path / "out"), until="documents")
    assert tables["artifacts"].first().sha256 != before and {r.state for r in tables["run_nodes"].collect()} == {"completed"}
    again = ingest.write(spark, str(folder), str(tmp_path / "out"), until="documents")["run_nodes"].groupBy("state").count().collect()
    assert {r.state for r in again} == {"completed", "resumed"}


def test_json_walks(spark):
    rows = spark.createDataFrame([(1, '{"path":"p","sha256":"s","schema_id":"i","schema_version":[2],"contract_id":null,"in":{"a/b":[{"path":1,"sha256":"t","schema_id":"","schema_version":"","contract_id":"c"}]}}'), (2, "[]"), (3, None), (4, "no"), (5, '"text"'), (6, "[" * 12 + '{"ids":["x","y","x",1]}' + "]" * 12)], "n long, body string")
    got = {(r.n, r.pointer, r.path, r.schema_version, r.contract_id) for r in json_tree.references(rows, "n", F.col("body")).collect()}
    assert got == {(1, "", "p", "[2]", "null"), (1, "/in/a~1b/0", "1", "", "c")}
    assert {(r.n, r.reference) for r in json_tree.string_references(rows, "n", F.col("body"), ["ids", "in"]).collect()} == {(6, "x"), (6, "y")}
    assert json_tree.references(rows.filter("n = 3"), "n", F.col("body")).columns == ["n", "pointer", "path", "sha256", "schema_id", "schema_version", "contract_id"]


def test_built_files_are_handed_on_before_a_batch_is_through():
    import pyarrow as pa

    from paperloom.plans import formats

    made = []
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(200), pa.int64())})
    files = formats.built(lambda r: made.append(r["id"]) or bytes(1 << 16), iter([batch]))
    first = next(files)
    assert len(made) == len(first) == formats.FILE_BYTES >> 16 < 200
    assert [*first["id"].to_pylist(), *(i for f in files for i in f["id"].to_pylist())] == list(range(200)) == made


def test_units_of_a_document_are_packed():
    import tracemalloc

    from paperloom.plans import formats
    from paperloom.sources import native

    data = formats.xlsx((f"A{i}", f"cell {i}") for i in range(1, 30_001))
    tracemalloc.start()
    units = native.packed("xlsx", "d", data)
    held, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert sum(1 for u in units if u["kind"] == "cell") == 30_000 and held < 20 << 20, (held, most)
