"""Rules on packages whose paths repeat, against plain loops."""

from collections import Counter

from paperloom import storage
from paperloom.operators import ir, package


def rules(df):
    return Counter((r.rule, r.run_id, r.subject) for r in df.collect())


def test_repeated_paths_count_every_pair_and_make_none(spark):
    shape = "run_id int, path string, sha256 string, size_bytes int"
    ours = [(1, "a", "x", 1)] * 3 + [(1, "a", "y", 2), (1, "a", None, None), (1, "b", "x", 1), (None, "a", "x", 1), (2, "c", "x", 5)]
    theirs = [(1, "a", "x", 1), (1, "a", "z", 2), (1, "a", None, 7), (2, "c", "y", None), (2, "d", "x", 1), (None, "a", "x", 1)]
    want = Counter()
    for run, path, sha, size in ours:
        met = [f for f in theirs if run is not None and f[:2] == (run, path)] or [(None,) * 4]
        for f in met:
            want["file_absent", run and str(run), path] += f[2] is None
            want["file_hash", run and str(run), path] += None not in (f[2], sha) and f[2] != sha
            want["file_size", run and str(run), path] += f[2] is not None and None not in (f[3], size) and f[3] != size
    found = package.package_file_failures(spark.createDataFrame(ours, shape), spark.createDataFrame(theirs, shape))
    got = rules(found.filter("rule IN ('file_absent', 'file_hash', 'file_size')"))
    assert got == +want


def test_many_pairs_of_a_path_are_dealt_over_tasks(spark):
    rows = spark.range(3_000).selectExpr("1 AS run_id", "'a' AS path", "CAST(id % 2 AS STRING) AS sha256", "1 AS size_bytes")
    found = package.package_file_failures(rows, rows).filter("rule = 'file_hash'")
    assert found.count() == 4_500_000
    spread = package._repeated(spark.sql("SELECT 'a' AS path, 4500000L AS n")).selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
    assert len(spread) > 1 and sum(r["count"] for r in spread) == 4_500_000


def test_references_are_shuffled_once_and_count_once(spark):
    references = spark.createDataFrame([(1, "o", "a", "x", "c"), (1, "o", "b", "x", "c"), (1, "p", "n", "x", "c"), (1, "p", "d", "x", "c")], "run_id int, owner string, path string, sha256 string, contract_id string")
    files = spark.createDataFrame([(1, "a", "x", "c"), (1, "a", "y", None), (1, "b", "x", "c"), (1, "b", None, "c")], "run_id int, path string, sha256 string, contract_id string")
    declared = spark.createDataFrame([(1, "b"), (1, "b"), (1, "d")], "run_id int, path string")
    found = package.nested_reference_failures(references, files, declared)
    assert rules(found) == Counter({("reference_hash", "1", "o > a"): 1, ("reference_header", "1", "o > a"): 1, ("reference_undeclared", "1", "o > a"): 1, ("reference_unresolved", "1", "o > b"): 1, ("reference_unresolved", "1", "p > n"): 1, ("reference_undeclared", "1", "p > n"): 1, ("reference_unresolved", "1", "p > d"): 1})
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("owner") and sum("LogicalRDD [run_id" in line and "owner" in line for line in plan.splitlines()) == 1


def test_rules_of_edges_are_evaluated_once(spark):
    from paperloom.operators import mapping

    edge = spark.createDataFrame([("d", "m", "odd", "native", "", "technical_ir", "t", "exact", 0.5, "x", None)], "document_id string, mapping_id string, relation string, source_layer string, source_id string, target_layer string, target_id string, exactness string, confidence double, method string, producer string")
    known = spark.createDataFrame([("d", "technical_ir", "t"), ("d", "native", "n")], "document_id string, layer string, entity_id string")
    found = mapping.edge_failures(edge, known)
    want = ["empty_source", "exact_confidence", "no_producer", "own_id", "unknown_relation", "unknown_source", "unmapped_native"]
    assert sorted(r.rule for r in found.collect()) == want
    assert found._jdf.queryExecution().optimizedPlan().toString().count("sha2(") == 1


def test_units_without_children_are_not_kept_in_the_search_for_cycles(spark, monkeypatch):
    rows = [("d", "root", None), ("d", "a", "b"), ("d", "b", "a"), ("e", "a", "a")] + [("d", f"leaf{i}", "root") for i in range(50)]
    tables, kept = {}, ir.kept
    monkeypatch.setattr(ir, "kept", lambda df, name: tables.setdefault(name, kept(df, name)))
    found = ir.on_cycles(spark.createDataFrame(rows, "document_id string, unit_id string, parent_id string"))
    assert {tuple(r) for r in found.collect()} == {("d", "a"), ("d", "b")}
    assert tables["parents"].count() == 2  # all 52 units that have a parent, before


def test_repeated_keys(spark):
    rows = spark.createDataFrame([("d", "m"), ("d", "m"), ("d", "n"), ("e", "m"), ("e", None), ("e", None), (None, "e"), ("d", "m")], "document_id string, mapping_id string")
    keys = ["document_id", "mapping_id"]
    assert {tuple(r) for r in storage.repeated(rows, keys).collect()} == {("d", "m", 3), ("e", None, 2)}
    assert storage.repeated(rows.distinct(), keys).count() == storage.repeated(rows.limit(0), keys).count() == 0
