import hashlib
import re

import pytest

from paperloom.llm import fill_in_middle as fim
from paperloom.llm import storage


def brute(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")):
        form, sizes, output = "plain", (None, None), text
    else:
        a, b = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
        prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
        form = "spm" if h4 % 100 < 50 else "psm"
        output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
        sizes = len(prefix), len(middle)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, n, form, *sizes, sha(output), sha(text))


def test_query_agrees_with_brute_force(spark):
    sf = "/root/testdata/sf0.01"
    want = sorted(brute(r.doc_id, r.text) for r in storage.documents(spark, sf).collect())
    got = fim.query(spark, sf)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == want and {w[2] for w in want} >= {"psm", "spm"}


def test_odd_rows(spark, odd_documents, frame):
    texts = ["\n", "\n\n\n", "a\n", "a\nb", "x<P>y\nz", "<\n<S\nP>\n<M", "é\r\n 漢\x0b\n\0", "ends<", ">M>\n<"]
    more = frame([((1 << 53) + i, t, None, "s") for i, t in enumerate(texts)] + [(None, None, None, None), (-5, "a\nb\nc", None, None)], "doc_id long, text string, lang string, start string")
    docs = odd_documents.unionByName(more).selectExpr("*", "'x' AS form", "1 AS `dotted.name`", "2 AS own")
    got = fim.fill_in_middle(docs)
    assert set(got.columns) == {*docs.columns, *fim.FIELDS}
    rows = got.collect()
    key = lambda r: str(r)
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256) for r in rows), key=key) == sorted((brute(r.doc_id, r.text) for r in docs.collect()), key=key)
    assert all(fim.restored(r.output, r.form) == (r.text or "") and r["dotted.name"] == 1 and r.own == 2 for r in rows)
    assert fim.fill_in_middle(frame([], "doc_id long, text string")).count() == 0


def test_rates_seeds_and_partitions(spark, frame):
    docs = frame([(i, "\n".join(f"line {i} {j}" for j in range(i % 9 + 1))) for i in range(400)], "doc_id int, text string")
    by = {r.form: r["count"] for r in fim.fill_in_middle(docs, rate=50, spm_rate=25).groupBy("form").count().collect()}
    assert 150 < by["plain"] < 250 and by["psm"] > 2 * by["spm"] > 40
    one, two = ({tuple(r) for r in fim.fill_in_middle(d).collect()} for d in (docs, docs.repartition(7, "text")))
    assert one == two and one != {tuple(r) for r in fim.fill_in_middle(docs, seed=8).collect()}
    words = fim.fill_in_middle(docs, unit=r"\S+\s*|\s+", sentinels=("[pre]", "[suf]", "[mid]"))
    assert all(fim.restored(r.output, r.form, ("[pre]", "[suf]", "[mid]")) == r.text and r.output.startswith("[") for r in words.collect())


@pytest.mark.parametrize("sentinels", [("a", "a", "b"), ("", "b", "c"), ("<a>", "x<a>y", "c"), ("ab", "ba", "c"), ("aa", "b", "c")])
def test_sentinels_that_overlap_are_refused(sentinels):
    with pytest.raises(ValueError):
        fim.check_sentinels(sentinels)


def test_linear_in_a_long_text(spark, frame):
    text = "0123456789\n" * 1_000_000
    (row,) = fim.fill_in_middle(frame([(1, text)], "doc_id long, text string"), with_output=False).collect()
    assert row.n == 1_000_000 and row.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
