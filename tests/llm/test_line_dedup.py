import hashlib
import re

import duckdb
from pyspark.sql import functions as F

from paperloom.llm import line_dedup, storage


def key(line):
    return re.sub(r"[A-Z]+", lambda m: m[0].lower(), re.sub(r"^[ \t-\r]+|[ \t-\r]+$", "", line))


def brute(rows, least=20, documents=3):
    held: dict = {}
    for i, (doc, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= least:
                held.setdefault(k, []).append(doc)
    out = []
    for doc, text in rows:
        lines, kept = (text or "").split("\n"), []
        for x in lines:
            docs = held.get(key(x), [])
            ids = [d for d in docs if d is not None]
            if not (len(docs) >= documents and ids and doc != max(ids)):
                kept.append(x)
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    rows = df.selectExpr("doc_id", "n_lines", "n_dropped", "sha2(kept_text, 256) AS h").collect()
    return sorted((tuple(r) for r in rows), key=str)


def test_sql_and_brute_force_agree(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in storage.documents(spark, sf).collect()]
    got = sorted((tuple(r) for r in line_dedup.query(spark, sf).collect()), key=str)
    assert got == brute(rows)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    assert sorted(con.sql(f"SELECT doc_id, n_lines, n_dropped, kept_sha256 FROM ({line_dedup.ORACLE})").fetchall(), key=str) == got


def test_odd_rows(spark, odd_documents, frame):
    line = "A common line of this corpus, É"
    rows = [(i, f"{line}\nown {i}\n  {line.lower().replace('é', 'É')}\t\n", i % 2) for i in range(40)]
    rows += [(None, line, 0), (39, line, 1), (39, line, 1), (100, "short\nshort", 0), (101, "short", 0), (102, "short\n\n", 0), (50, line.lower(), 5), (7, f"x\n{line}", 0), (41, "", 0), (42, None, 0)]
    docs = frame(rows, "doc_id long, text string, n_lines int").selectExpr("*", "1 AS h1", "2 AS pos", "3 AS row_hash", "4 AS line_doc", "5 AS `a.b`", "6 AS batch")
    got = line_dedup.dedup(docs)
    assert digest(got) == brute([(a, b) for a, b, _ in rows])
    assert set(docs.columns) <= set(got.columns) and {(r.row_hash, r['a.b'], r.batch) for r in got.collect()} == {(3, 5, 6)}
    assert digest(line_dedup.dedup(odd_documents)) == brute([(r.doc_id, r.text) for r in odd_documents.collect()])
    assert line_dedup.dedup(frame([], "doc_id long, text string")).count() == 0


def test_runs_are_merged_by_level(spark, frame):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for b in range(4, 0, -1):
        docs = frame([(10 * b + i, "the very same long line\nanother line with %d inside it" % (10 * b + i)) for i in range(2)], "doc_id long, text string")
        runs.add(line_dedup.line_hashes(docs))
    assert [len(level) for level in runs.levels] == [0, 0, 1]
    assert [r.last_doc for r in runs.frequent().collect()] == [41]


def test_runs_merge_without_shuffle_and_compacted_ones_meet_batches(spark, frame):
    rows = [(i, f"a line that many hold {i % 7} of them\nand a line of its own, number {i}") for i in range(60)]
    hashed = line_dedup.line_hashes(frame(rows, "doc_id long, text string"))
    runs, met = line_dedup.LineRuns(spark, fanout=2), []
    for batch in line_dedup.batches(hashed)[1]:
        met.append([len(level) for level in runs.levels])
        runs.add(batch)
    assert len(met) == line_dedup.LEAST_BATCHES and any(sum(levels[1:]) for levels in met)
    run = runs._runs()[0][0]
    new = hashed.select("doc_id", F.explode("hashes").alias("h")).groupBy("h.h1", "h.h2").agg(F.count("*").alias("n"))
    plan = new.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"], "left_anti")._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("SortMergeJoin") :].rsplit("+-", 1)
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan, scan
    assert {r.last_doc for r in runs.frequent().collect()} == set(range(53, 60))


def test_each_batch_reads_its_own_files(spark, frame):
    rows = [(None if i % 50 == 7 else (i * 7919) % 3000, f"line of text number {i % 40} that is long") for i in range(3000)]
    whole, parts = line_dedup.batches(line_dedup.line_hashes(frame(rows, "doc_id long, text string").repartition(8)), 5)
    seen, last = set(), None
    for part in parts:
        files = {r[0] for r in part.select(F.input_file_name()).distinct().collect()}
        assert files and not files & seen and all("/batch=" in f for f in files)
        assert re.search(r"PartitionFilters: \[isnotnull\(batch#\d+\), \(batch#\d+ = \d\)\]", part._jdf.queryExecution().executedPlan().toString())
        seen |= files
        ids = [r.doc_id for r in part.select("doc_id").collect()]
        known = [i for i in ids if i is not None]
        assert last is None or max(known) < last
        last = min(known)
    assert None in ids and whole.count() == len(rows) == sum(p.count() for p in parts)
