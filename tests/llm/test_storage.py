import os
from urllib.parse import urlparse

from paperloom.llm import storage


def test_smallest_hashes_bound_and_agree(spark):
    rows = spark.range(5000).toDF("k")
    want = [r.k for r in rows.selectExpr("k", "xxhash64(k) AS h").orderBy("h", "k").limit(100).collect()]
    assert [r.k for r in storage.smallest_hashes(rows, "k", 100, 5000).collect()] == want
    assert storage.smallest_hashes(rows, "k", 9000, 5000).count() == 5000 and storage.smallest_hashes(rows.limit(0), "k", 10, 0).count() == 0


def test_files_and_tables_in_the_shared_folder(spark):
    base = storage.shared_dir(spark)
    assert storage.shared_dir(spark) == base == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    with storage.open_new(f"{base}/elsewhere/a b.bin") as f:
        f.write(b"x")
    assert storage.read_all(f"{base}/elsewhere/a b.bin") == b"x"
    kept = storage.staged(spark.range(3).toDF("k"), "t")
    assert sorted(r.k for r in kept.collect()) == [0, 1, 2]
    storage.discard(spark)
    assert not os.path.exists(urlparse(base).path + "/paperloom") and storage.staged(spark.range(1).toDF("k"), "t").count() == 1
