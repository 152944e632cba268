"""Cycles and components: the same as by brute force, in few written rounds."""

import random

from paperloom.operators import graph


def brute(edges):
    after = {}
    for a, b in edges:
        after.setdefault(a, set()).add(b)

    def reach(node):
        seen, todo = set(), list(after.get(node, ()))
        while todo:
            at = todo.pop()
            if at not in seen:
                seen.add(at)
                todo += after.get(at, ())
        return seen

    reached = {a: reach(a) for a in after}
    return {a: min(b for b in reached[a] if a in reached.get(b, ())) for a in after if a in reached[a]}


def rounds(monkeypatch):
    written, kept = [], graph.kept
    monkeypatch.setattr(graph, "kept", lambda df, name="stage": written.append(name) or kept(df, name))
    return written


def test_random_graphs_have_the_components_of_brute_force(spark):
    rnd, edges = random.Random(3), []
    for g in range(12):
        n = rnd.randint(2, 25)
        edges += [(f"{g:02}-{rnd.randrange(n):02}", f"{g:02}-{rnd.randrange(n):02}") for _ in range(int(n * rnd.choice([0.8, 1.0, 1.2, 1.5])))]
        edges += [(f"{g:02}-{i}", f"{g:02}-{i + 1}") for i in range(30, 50)] + [(f"{g:02}-{rnd.randrange(30, 50)}", f"{g:02}-{rnd.randrange(30, 50)}") for _ in range(2)]
    rows = spark.createDataFrame(edges, "node string, parent string")
    assert {r.node: r.component for r in graph.strongly_connected(rows).collect()} == brute(edges)


def test_short_cycles_end_after_few_rounds_however_many_they_are(spark, monkeypatch):
    written = rounds(monkeypatch)
    rows = spark.range(20_000).selectExpr("id AS node", "CASE WHEN id % 10 = 9 THEN id - 4 ELSE id + 1 END AS parent")
    assert graph.on_cycles(rows).count() == 10_000
    assert len(written) <= 8, written


def test_a_long_chain_of_many_parents_takes_few_rounds(spark, monkeypatch):
    written = rounds(monkeypatch)
    n = 2_000
    edges = [(i, i + 1) for i in range(n)] + [(i, i + 10) for i in range(3, n, 50)] + [(i, i - 25) for i in range(48, n, 100)]
    rows = spark.createDataFrame(edges, "node long, parent long")
    assert {r.node: r.component for r in graph.strongly_connected(rows).collect()} == brute(edges)
    assert len(written) <= 60, written


def test_groups_of_single_parents_need_no_components(spark, monkeypatch):
    from paperloom.operators import package

    monkeypatch.setattr(graph, "strongly_connected", None)
    rows = spark.range(2_000).selectExpr("nullif(id div 10, 7) AS run_id", "id AS owner", "CASE WHEN id % 10 = 9 THEN id - 4 WHEN id % 10 = 1 THEN id ELSE id + 1 END AS path")
    got = {(r.run_id, r.subject) for r in package.cycle_failures(rows).collect()}
    assert got == {(None if i // 10 == 7 else str(i // 10), str(i)) for i in range(2_000) if i % 10 >= 5 or i % 10 == 1}


def test_groups_with_several_parents_are_found_too(spark):
    from paperloom.operators import package

    rows = spark.createDataFrame([(1, "a", "b"), (1, "b", "a"), (1, "b", "c"), (1, "c", "d"), (None, "a", "b"), (None, "a", "c"), (None, "c", "a"), (2, "a", "b"), (2, "b", "b"), (2, None, "a")], "run_id int, owner string, path string")
    got = {(r.run_id, r.subject) for r in package.cycle_failures(rows).collect()}
    assert got == {("1", "a"), ("1", "b"), (None, "a"), (None, "c"), ("2", "b")}
