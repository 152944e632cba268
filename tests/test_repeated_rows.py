"""Pairs of a path are given as rows that are copied whole."""

from paperloom.operators import package


def test_every_row_comes_as_often_as_it_says(spark):
    counts = [None, -1, 0, 1, 255, 256, 257, 4096, 70_000, (1 << 18) - 1, 1 << 18, (1 << 18) + 1, (1 << 19) + 300]
    rows = spark.createDataFrame([(f"p{i}", None if i % 2 else i, n) for i, n in enumerate(counts)], "path string, k int, n long")
    found = package._repeated(rows)
    assert found.columns == ["path", "k"]
    got = {(r.path, r.k): r["count"] for r in found.groupBy("path", "k").count().collect()}
    assert got == {(f"p{i}", None if i % 2 else i): n for i, n in enumerate(counts) if (n or 0) > 0}


def test_pairs_are_finished_before_they_are_repeated(spark):
    rows = spark.range(2_000).selectExpr("1 AS run_id", "'a' AS path", "CAST(id % 2 AS STRING) AS sha256", "CAST(id % 4 AS INT) AS size_bytes")
    found = package.package_file_failures(rows, rows)
    assert {r.rule: r["count"] for r in found.groupBy("rule").count().collect()} == {"file_hash": 2_000_000, "file_size": 3_000_000, "path_twice": 1}
    assert {tuple(r) for r in found.filter("rule = 'file_size'").distinct().collect()} == {("1", None, "file_size", "integrity", package.INTEGRITY, "critical", True, "a")}
    # the product is the outermost step of whole blocks: no column is made again for each of their rows
    plan = found._jdf.queryExecution().sparkPlan().toString().splitlines()
    assert sum(line.lstrip().startswith((":- CartesianProduct", "+- CartesianProduct")) for line in plan) == 3
