import base64
import hashlib
import json
import random
import time

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paperloom.functions import identity, scalar, windows
from paperloom.functions.ranks import STATUS, gravest
from paperloom.functions.windows import running_total
from paperloom.operators import graph, render, text, validate
from paperloom.sources import ids

ODD = ["", "plain", "é漢字", 'quote " and \\ back', "\x1f\x0b\t\n\r\f\b", "\\u001F literal", "\\\\u001F", "</script>", "\x7f "]


def stable(prefix, value):
    data = json.dumps(value, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()
    return f"{prefix}_{base64.b32encode(hashlib.sha256(data).digest()).decode().lower()[:26]}"


def test_identity_agrees_everywhere(spark):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(99, None)], "n long, t string")
    json_text = identity.canonical_json(b=F.col("t"), a=F.col("n"))
    got = {r.n: (r.j, r.s) for r in rows.select("n", json_text.alias("j"), identity.stable_id("x", json_text).alias("s")).collect()}
    for n, t in [*enumerate(ODD), (99, None)]:
        assert got[n] == (json.dumps({"a": n, "b": t}, ensure_ascii=False, sort_keys=True, separators=(",", ":")), stable("x", {"a": n, "b": t}))
        assert ids.stable("x", a=n, b=t) == got[n][1]
    assert ids.content_hash({"header": {"created_at": 1, "v": 2}, "x": [1]}) == ids.content_hash({"x": [1], "header": {"v": 2, "content_hash": "z"}})
    with pytest.raises(ValueError):
        ids.canonical({"x": float("nan")})


def test_lines_match_python(spark):
    texts = ["", "a", "a\n", "\n\n", "a\r\nb\rc\nd", "é\n漢字\r\n", "x\n\r\ny", "a\0b\nc", "\0", "a\x0bb\x0c\x1cc\x1d\x1ed\x85e\u2028f\u2029", "x\r\r\n\n" * 1000, "é\n" * 2048]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "document_id string, text string")
    got = {}
    for r in text.lines(rows).orderBy("document_id", "ordinal").collect():
        got.setdefault(r.document_id, []).append((r.byte_start, r.byte_end, r.text))
    for i, t in enumerate(texts):
        want, at = [], 0
        for raw in t.splitlines(keepends=True):
            line = raw.rstrip("\r\n")
            want.append((at, at + len(line.encode()), line))
            at += len(raw.encode())
        assert got.get(str(i), []) == want


def test_lines_take_linear_time(spark):
    took = []
    for n in (250_000, 500_000, 1_000_000):
        rows = spark.range(1).select(F.lit("d").alias("document_id"), F.expr(f"repeat('a line of text\n', {n})").alias("text"))
        began = time.perf_counter()
        row = text.lines(rows).agg(F.count("*").alias("n"), F.max("byte_end").alias("end"), F.max("ordinal").alias("last")).first()
        took.append(time.perf_counter() - began)
        assert (row.n, row.end, row.last) == (n, 15 * n - 1, n - 1)
    assert took[2] < 30 and took[2] < 4 * took[1] + 5, took


def test_newlines_and_controls(spark):
    rows = spark.createDataFrame([("a\nb",), ("a\r\n",), ("\r",), ("a\r\n\n",), ("",), ("\x01x\x1f\x01",)], "t string")
    got = rows.select(text.newline_style(F.col("t")).alias("s"), text.control_findings(F.col("t")).alias("c")).collect()
    assert [r.s for r in got] == ["lf", "crlf", "cr", "mixed", "none", "none"] and got[-1].c == ["U+0001", "U+001F"]


def test_names_addresses_formulas(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    names = {"fontSize": "font_size", "HTMLParser": "html_parser", "already.ok": "already.ok", "{ns}val": "val", "9lives": "property_9lives", "": "property_unknown", "A": "a_value", "a b--c": "a_b--c"}
    for native, want in names.items():
        assert one(scalar.property_name(F.lit(native))) == want
    assert len(one(scalar.property_name(F.lit("Ab" * 200)))) <= 201
    assert [one(scalar.a1_column(F.lit(a))) for a in ("A1", "Z9", "AA1", "$AB$7", "ZZ1")] == [1, 26, 27, 28, 702]
    assert one(scalar.a1_address(F.lit(3), F.lit(702))) == "ZZ3" and one(scalar.a1_address(F.lit(1), F.lit(27))) == "AA1"
    assert one(scalar.formula_dependencies(F.lit("SUM(B2:$B$3)+'My S'!A1+B2"))) == ["$B$3", "'My S'!A1", "B2"]
    assert one(scalar.is_volatile(F.lit("1+now ()"))) and not one(scalar.is_volatile(F.lit("KNOW(1)")))
    assert one(scalar.rels_source_part(F.lit("word/_rels/document.xml.rels"))) == "word/document.xml" and one(scalar.rels_source_part(F.lit("_rels/.rels"))) is None
    assert [one(scalar.is_portable_path(F.lit(p))) for p in ("a/b", "/a", "a\\b", "a/../b", "")] == [True, False, False, False, False]
    assert [one(scalar.rotation(F.lit(d))) for d in (-90, 450, 45)] == [270, 90, 0]
    assert one(scalar.weighted_ratio(F.lit(1), F.lit(0), F.lit(128))) == 0.007812 and one(scalar.weighted_ratio(F.lit(0), F.lit(0), F.lit(0))) is None


def test_windows_ranks_graphs(spark):
    rows = spark.createDataFrame([(i, i % 7) for i in range(200)], "k long, v long")
    got = {r.k: r.t for r in running_total(rows, F.col("v"), "k", "t").collect()}
    assert got == {k: sum(i % 7 for i in range(k + 1)) for k in range(200)}
    states = spark.createDataFrame([("a", "ok"), ("a", "error"), ("b", "review"), ("b", "ok")], "k string, s string")
    assert {r.k: r.s for r in states.groupBy("k").agg(gravest(F.col("s"), STATUS).alias("s")).collect()} == {"a": "error", "b": "review"}
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("e", "f")], "node string, parent string")
    assert {r.node for r in graph.on_cycles(edges).collect()} == {"a", "b", "c"}
    chain = spark.createDataFrame([(i, i + 1) for i in range(100)], "node long, parent long")
    address = spark.createDataFrame([(i, "top" if i == 100 else None) for i in range(101)], "node long, address string")
    assert {r.address for r in graph.nearest(address, chain).collect()} == {"top"}


def test_pages(spark):
    assert (render.line_characters(), render.page_lines(), render.line_characters(render.SLIDE), render.page_lines(render.SLIDE)) == (73, 47, 124, 27)
    lines = spark.createDataFrame([("d", 0, "u", "A" * 12_000), ("d", 1, "v", "second line"), ("d", 2, "w", "")], "document_id string, ordinal long, unit_id string, text string")
    for segments in (render.paginate(lines), render.paginate_words(lines)):
        rows = segments.collect()
        assert max(r.page for r in rows) >= 2 and {r.unit_id for r in rows} == {"u", "v", "w"}
        assert "".join(r.segment for r in sorted(rows, key=lambda r: (r.page, r.slot)) if r.unit_id == "u") == "A" * 12_000
        assert len({(r.page, r.slot) for r in rows}) == len(rows)
    assert render.wrap_words("one two three", 8) == ["one two ", "three"]
    svg = render.svg_lines(render.boxes(render.paginate(lines)), F.lit("a<b")).collect()
    assert all(s.svg.startswith("<svg") and "a&lt;b" in s.svg for s in svg)


def test_rendering_rules(spark):
    rows = spark.createDataFrame([("s", ["a"], ["a", "b"], ["c"], ["a"])], "surface_id string, serialized array<string>, visible array<string>, clipped array<string>, omitted array<string>")
    assert {r.rule for r in validate.rendering_failures(rows).collect()} == {"visible_not_serialized", "clipped_not_visible", "omitted_serialized"}


def test_names_outside_ascii(spark):
    rows = spark.createDataFrame([("ﬁleName",), ("Ｗidth",), ("docProps",), ("é",), ("x" * 300 + "é",)], "name string")
    got = {r.name: r.canonical for r in scalar.property_names(rows, "name", "canonical").collect()}
    assert (got["ﬁleName"], got["Ｗidth"], got["docProps"], got["é"]) == ("file_name", "width", "doc_props", "property_unknown")
    assert len(got["x" * 300 + "é"]) <= 201


def test_pointer_jumping(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1000)] + [(2000, 2001), (2001, 2000), (2002, 2000)], "node long, parent long")
    values = spark.createDataFrame([(1000, "a", "top"), (500, "a", "middle"), (700, "b", "late"), (2001, "a", "round")], "node long, name string, value string")
    got = {(r.node, r.name): r.value for r in graph.inherited(values, edges).collect()}
    assert got == {**{(i, "a"): "middle" for i in range(501)}, **{(i, "a"): "top" for i in range(501, 1001)}, **{(i, "b"): "late" for i in range(701)}, (2000, "a"): "round", (2001, "a"): "round", (2002, "a"): "round"}
    assert {r.node for r in graph.on_cycles(edges).collect()} == {2000, 2001}


def components_by_closure(edges):
    """(node, component) of the nodes on cycles, by walking from every node."""
    after = {}
    for a, b in edges:
        if a is not None and b is not None:
            after.setdefault(a, set()).add(b)
    reach = {}
    for a in after:
        seen, todo = set(), list(after[a])
        while todo:
            x = todo.pop()
            if x not in seen:
                seen.add(x)
                todo += after.get(x, ())
        reach[a] = seen
    return {(a, min(b for b in reach[a] if a in reach.get(b, ()))) for a in after if a in reach[a]}


def test_strongly_connected_components(spark):
    bridge = [("A", "B"), ("B", "A"), ("B", "C"), ("C", "D"), ("D", "E"), ("E", "D"), ("F", "F"), ("F", "G"), (None, "A"), ("A", None), ("A", "B")]
    got = {(r.node, r.component) for r in graph.strongly_connected(spark.createDataFrame(bridge, "node string, parent string")).collect()}
    assert got == components_by_closure(bridge) == {("A", "A"), ("B", "A"), ("D", "D"), ("E", "D"), ("F", "F")}
    rng = random.Random(4)
    for n, m in ((40, 45), (60, 90), (30, 200)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        assert {tuple(r) for r in graph.strongly_connected(spark.createDataFrame(edges, "node long, parent long")).collect()} == components_by_closure(edges)
    assert graph.strongly_connected(spark.createDataFrame([], "node long, parent long")).count() == 0


def test_rounds_do_not_follow_the_longest_path(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graph, "kept", lambda df, name, real=graph.kept: (rounds.append(name), real(df, name))[1])
    n = 800
    edges = [(i, i + 1) for i in range(n)] + [(n, n - 3)] + [(i, i + 1) for i in range(5000, 5000 + n)] + [(5000 + n, 5000)]
    got = graph.strongly_connected(spark.createDataFrame(edges, "node long, parent long"))
    assert {r.node for r in got.collect()} == {*range(n - 3, n + 1), *range(5000, 5001 + n)}
    assert len(rounds) < n / 5, len(rounds)


def test_running_totals_over_sparse_repeated_and_null_keys(spark):
    rng = random.Random(9)
    keys = [None, -(1 << 63), (1 << 63) - 1, 0, *[rng.getrandbits(63) for _ in range(150)]]
    rows = [(rng.choice(keys), rng.choice([None, 1, 5, -2]), i) for i in range(700)] + [(7, 1, -i) for i in range(1, 300)]
    df = spark.createDataFrame(rows, "k long, v long, i long").withColumn("x.y", F.lit(1))
    duck = duckdb.connect()
    duck.register("t", pa.table({c: pa.array([r[j] for r in rows], pa.int64()) for j, c in enumerate(["k", "v", "i"])}))
    for by, order in ((["k"], "k"), (["k", "i"], "k, i")):
        want = sorted(duck.sql(f"SELECT i, CAST(sum(coalesce(v, 0)) OVER (ORDER BY {order}) AS BIGINT) FROM t").fetchall())
        assert sorted((r.i, r.t) for r in running_total(df, F.col("v"), by, "t").collect()) == want
    want = sorted(duck.sql("SELECT i, row_number() OVER (PARTITION BY k ORDER BY v, i) - 1 FROM t").fetchall())
    assert sorted((r.i, r.n) for r in windows.numbered(df, ["v", "i"], "n", within=["k"]).collect()) == want
    assert sorted(r.n for r in windows.numbered(df, ["i"], "n").collect()) == list(range(len(rows)))
    assert running_total(df.limit(0), F.col("v"), "k", "t").count() == 0


def test_numbers_as_python_writes_them(spark):
    rng = random.Random(2)
    numbers = [0.0, -0.0, 1.0, -1.5, 100.0, 1e15, 1e16, 123456789012345680.0, 1e-4, 1e-5, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, 1e22, 1e23, 2e-3, 1 / 3]
    numbers += [round(rng.uniform(-1000, 1000), rng.randint(0, 6)) for _ in range(3000)] + [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(3000)]
    rows = spark.createDataFrame([(x,) for x in numbers], "d double").select("d", identity.number_text(F.col("d")).alias("t")).collect()
    assert all(float(r.t) == r.d and len(r.t) == len(repr(r.d)) for r in rows)
    assert sum(r.t == repr(r.d) for r in rows) > 0.99 * len(rows) and all(r.t == repr(r.d) for r in rows[:17])


def test_canonical_json_of_nested_values(spark):
    schema = "v struct<b:int,a:string,header:struct<version:string,content_hash:string,created_at:string,more:struct<created_at:string>>,list:array<struct<z:double,y:boolean>>,by:map<string,array<int>>,deep:map<string,map<string,string>>>"
    value = {"b": 3, "a": 'q"\u0001\x1f漢', "header": {"version": "2", "content_hash": "x", "created_at": "y", "more": {"created_at": "stays"}}, "list": [{"z": 1e-7, "y": True}, {"z": 2.0, "y": None}, None], "by": {"é": [1, None], "B": [], "a": None}, "deep": {"header": {"content_hash": "x", "k": "v"}, "other": {"content_hash": "x"}}}
    rows = spark.createDataFrame([(value,), (None,)], schema)
    kind = rows.schema["v"].dataType
    got = [r[0] for r in rows.select(identity.canonical_value(F.col("v"), kind)).collect()]
    want = {**value, "header": {"version": "2", "more": {"created_at": "stays"}}, "deep": {**value["deep"], "header": {"k": "v"}}}
    assert got == [json.dumps(want, ensure_ascii=False, sort_keys=True, separators=(",", ":")), "null"]
    with pytest.raises(Exception, match="finite"):
        spark.createDataFrame([(float("nan"),)], "d double").select(identity.canonical_value(F.col("d"), T.DoubleType())).collect()
    with pytest.raises(TypeError):
        identity.canonical_value(F.lit(1), T.DateType())


def test_unit_ids_are_compiled_and_hashed_once(spark):
    from paperloom.operators import ir

    rows = spark.createDataFrame([("d", "u1", "line", None, 0, "x"), ("d", "u2", "line", "u1", 1, "y"), ("d", "u3", "line", "gone", 2, "z")], "document_id string, unit_id string, kind string, parent_id string, ordinal int, text string")
    found = ir.project(rows.withColumn("properties", F.create_map().cast("map<string,string>")))
    got = {r.native_id: r for r in found.collect()}
    root = ir.roots(rows).first().unit_id
    assert got["u1"].parent_id == got["u3"].parent_id == root and got["u2"].parent_id == got["u1"].unit_id
    assert "lambda" not in found.select("unit_id", "parent_id")._jdf.queryExecution().optimizedPlan().toString()
