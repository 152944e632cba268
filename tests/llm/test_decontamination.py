import re

import duckdb

from paperloom.llm import decontamination, storage


def shingles(text, shorter=()):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    runs = lambda n: {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)}
    own = runs(5) if len(w) >= 5 else {" ".join(w)} if w else set()
    return own.union(*[runs(n) for n in shorter if len(w) > n])


def brute(docs, items, least=0.8):
    shorter = {len(s.split()) for _, x in items for s in shingles(x)} - {5}
    out = set()
    for d, t in docs:
        own = shingles(t, shorter)
        for i, x in items:
            s = shingles(x)
            if s and len(s & own) / len(s) >= least:
                out.add((d, i, len(s), len(s & own)))
    return out


def test_sql_and_brute_force_agree(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in storage.documents(spark, sf).collect()]
    items = [(r.item_id, r.text) for r in storage.documents(spark, sf, "benchmark").collect()]
    got = {(r.doc_id, r.item_id, r.n_shingles, r.n_matched) for r in decontamination.query(spark, sf).collect()}
    assert got == brute(docs, items) and got
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    assert set(con.sql(f"SELECT doc_id, item_id, n_shingles, n_matched FROM ({decontamination.ORACLE})").fetchall()) == got


def test_partial_copies_in_long_texts(spark, frame, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    items = [(n, " ".join(words[:n])) for n in (1, 3, 4, 5, 6, 9, 14, 24, 25, 59)] + [(100, ""), (101, None), (102, "w0 w1 w2 w3 w4"), (None, "w5 w6 w7 w8 w9")]
    filler = "fill " * 30_000
    docs = [(1000 + n, filler + " ".join(words[:n]).upper() + ", " + filler) for n in range(3, 60)]
    docs += [(1, "w0"), (2, "w0 w1 w2"), (3, None), (4, ""), (5, "W0, w1; w2... w3!"), (None, " ".join(words)), (7, "w0 w1 w2 w3 w4"), (7, "w0 w1 w2 w3 w4"), (7, "something else entirely, this one")]
    d = frame(docs, "doc_id long, text string").selectExpr("*", "'x' AS words", "1 AS row_hash", "2 AS sketch")
    b = frame(items, "item_id long, text string").selectExpr("*", "3 AS n")
    want = brute(docs, items)
    for rows in (decontamination.BROADCAST_BYTES, 0):
        monkeypatch.setattr(decontamination, "BROADCAST_BYTES", rows)
        got = decontamination.contained(d, b).collect()
        assert {(r.doc_id, r.item_id, r.n_shingles, r.n_matched) for r in got} == want
    kept = decontamination.clean(d, b)
    assert kept.columns == d.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted((x, t) for x, t in docs if not brute([(x, t)], [(i, y) for i, y in items if len((y or '').split()) >= 3]) and (t or '').lower() != 'w0')


def test_empty_tables(spark, frame):
    d, b = frame([], "doc_id long, text string"), frame([], "item_id long, text string")
    one, item = frame([(1, "a b c d e f")], "doc_id long, text string"), frame([(1, "a b c d e f")], "item_id long, text string")
    assert decontamination.contained(d, item).count() == decontamination.contained(one, b).count() == 0
    assert decontamination.clean(one, b).count() == 1 and decontamination.clean(one, item).count() == 0


def test_short_items_inside_long_documents(spark, frame):
    items = [(1, "capital of france"), (2, "Paris"), (3, "the answer is forty two"), (4, "two words")]
    docs = [(1, "What is the capital of France, please tell me now"), (2, "capital of france"), (3, "Paris in spring is nice to see"), (4, "capital of, well, france and so on and on"), (5, "paris!"), (6, "these two words"), (7, "so the answer is forty two"), (8, "two, words")]
    d, b = frame(docs, "doc_id long, text string").selectExpr("*", "1 AS `a.b`"), frame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contained(d, b).collect()}
    assert got == {(1, 1), (2, 1), (3, 2), (5, 2), (6, 4), (8, 4), (7, 3)} == {x[:2] for x in brute(docs, items)}
    assert {r.doc_id for r in decontamination.clean(d, b).collect()} == {3, 4, 6}
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.sql("CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert set(con.sql(f"SELECT doc_id, item_id FROM ({decontamination.ORACLE})").fetchall()) == got
