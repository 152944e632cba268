import hashlib
import random

import numpy as np
import pytest

from paperloom.llm import storage, suffix_dedup


def brute(documents: list[tuple[int, str | None]]) -> list[tuple]:
    """The same by a table of all strings, for tests and small tables."""
    seen: set[bytes] = set()
    out = []
    for doc_id, text in sorted(documents, key=lambda r: r[0]):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - 100 + 1):
            w = data[s : s + 100]
            if w in seen:
                gone[s : s + 100] = b"\x01" * 100
            seen.add(w)
        kept = bytes(x for x, g in zip(data, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def digests(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect())


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in storage.documents(spark, sf).collect()]
    assert sorted(tuple(r) for r in suffix_dedup.query(spark, sf).collect()) == brute(rows)


def crafted():
    rng = random.Random(4)
    letters = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    passages = [letters(n) for n in (99, 100, 101, 130, 170, 400)]
    line = letters(70)
    rows = []
    for i in range(160):
        parts = [letters(rng.randint(0, 300)), rng.choice(passages), letters(rng.randint(0, 40)), rng.choice(passages)[rng.randint(0, 60) :], line, letters(20)]
        rng.shuffle(parts)
        rows.append((i * 3, "".join(parts)))
    edited = letters(900)
    for i in range(40):
        at = rng.randrange(900)
        rows.append((1000 + i, edited[:at] + "Z" + edited[at + 1 :]))
    rows += [(2000, None), (2001, ""), (2002, "x" * 99), (2003, "x" * 100), (2004, "x" * 5000), (2005, "ab" * 300), (2006, "\0" * 150 + "q"), (2007, "\0" * 150), (2008, letters(100) * 3)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_crafted_overlaps(spark, frame, monkeypatch, small):
    rows = crafted()
    if small:  # several blocks, shards and dealt-out anchors; workers get the values through the pickled stages
        monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4096)
    random.Random(1).shuffle(rows)
    docs = frame(rows, "doc_id long, text string").selectExpr("*", "7 AS n_bytes").repartition(5)
    assert digests(suffix_dedup.dedup(docs)) == brute(rows)


def test_stages_with_small_blocks_shards_and_groups(monkeypatch, tmp_path):
    """The stages run one after the other in this process, with bounds that split everything."""
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 6000)
    monkeypatch.setattr(suffix_dedup, "PIECE_BYTES", 2000)
    monkeypatch.setattr(suffix_dedup, "GROUP", 7)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 3000)
    rows, path = crafted(), str(tmp_path)

    def batches(messages, *keys):
        rows = sorted((r for b in messages for r in b.to_pylist()), key=lambda r: tuple(r[k] for k in keys))
        return [pa.RecordBatch.from_pylist(rows[i : i + 50], messages[0].schema) for i in range(0, len(rows), 50)]

    texts = [pa.RecordBatch.from_pylist([{"doc_id": d, "text": (t or "").encode()} for d, t in rows[i::3]], pa.schema([("doc_id", pa.int64()), ("text", pa.binary())])) for i in range(3)]
    sent = list(suffix_dedup.scan(path, 5, iter(texts)))
    met = list(suffix_dedup.meet(iter(batches(sent, "bucket"))))
    rows_of = lambda ms, *kinds: [pa.RecordBatch.from_pylist([r for b in ms for r in b.to_pylist() if r["kind"] in kinds], suffix_dedup._MESSAGE)]
    contexts = list(suffix_dedup.fetch(path, iter(batches(rows_of(met, "wanted"), "file", "block"))))
    compared = list(suffix_dedup.compare(suffix_dedup.RANGE_BITS, iter(batches(contexts, "anchor", "salt"))))
    strings = rows_of(compared, "strings")
    assert len(strings[0]) > 20 and any(r["salt"] > 0 for b in contexts for r in b.to_pylist())
    merged = list(suffix_dedup.merge(iter(batches(strings, "bucket"))))
    assert sum(len(b) for b in merged) > 0
    spans = [*rows_of(met, "block", "spans"), *rows_of(compared, "spans"), *rows_of(merged, "spans")]
    got = [r for b in suffix_dedup.cut(path, iter(batches(spans, "file", "block"))) for r in b.to_pylist()]
    assert sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in got) == brute(rows)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(2)
    for letters in (1, 2, 4, 250):
        data = rng.integers(0, letters, 700).astype(np.uint8)
        data[350:520] = data[20:190]
        order, group = suffix_dedup.suffix_array(data)
        prefix = [bytes(data[i : i + 100]).ljust(100, b"\0") for i in range(len(data))]
        assert [prefix[i] for i in order] == sorted(prefix)
        lanes = np.array([0, 100, 350, 351, 600])
        shared = suffix_dedup.common_prefixes(data, order, lanes)
        known = suffix_dedup.common_prefixes(data, order, lanes, group)
        assert np.array_equal(shared == 100, known == 100) and np.array_equal(shared, known)
        for a, b in zip(order, order[1:]):
            x, y = bytes(data[a : a + 100]), bytes(data[b : b + 100])
            want = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
            assert shared[b] == want


def test_odd_rows(spark, odd_documents, frame):
    got = suffix_dedup.dedup(odd_documents).collect()
    assert len(got) == odd_documents.count()
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    assert by_id[0][0].n_bytes == 0 and by_id[5][0].n_removed == 69_999 and by_id[5][0].n_spans == 1
    assert suffix_dedup.dedup(frame([], "doc_id long, text string")).count() == 0
    copies = frame([(1, "k" * 40 + "j" * 80)] * 2 + [(None, "k" * 40 + "j" * 80)], "doc_id long, text string")
    assert sorted(r.n_removed for r in suffix_dedup.dedup(copies).collect()) == [0, 120, 120]


def test_runs_merge_by_binary_search():
    rng = np.random.default_rng(5)
    for n in (1, 2, 3, 7):
        runs = []
        for i in range(n):
            key = np.sort(rng.integers(0, 50, rng.integers(0, 40)).astype(np.uint64))
            runs.append([key, np.full(len(key), i)])
        got = suffix_dedup.merged_runs(runs)
        order = np.argsort(np.concatenate([r[0] for r in runs]), kind="stable")
        assert np.array_equal(got[0], np.concatenate([r[0] for r in runs])[order]) and np.array_equal(got[1], np.concatenate([r[1] for r in runs])[order])
