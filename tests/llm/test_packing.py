import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from paperloom.llm import packing, storage

WORDS = public_tokenizers.path("word_bpe_49k.json")


def check(pieces, rows, length):
    """Every id of every document lies in exactly one piece; sequences are gapless and full or a power of two."""
    t = Tokenizer.from_file(WORDS)
    want = sorted((str(d), tuple([*t.encode(x or "", add_special_tokens=False).ids, 1])) for d, x in rows)
    parts: dict = {}
    for p in pieces:
        assert p.length == len(p.ids) // 4 > 0 and p.start + p.length <= p.doc_tokens
        parts.setdefault((str(p.doc_id), p.doc_tokens), []).append(p)
    if len({d for d, _ in rows}) == len(rows):
        got = []
        for (d, n), own in parts.items():
            own.sort(key=lambda p: p.start)
            assert [p.start for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]] and sum(p.length for p in own) == n
            got.append((d, tuple(np.frombuffer(b"".join(p.ids for p in own), "<u4").tolist())))
        assert sorted(got) == want
    assert sum(p.length for p in pieces) == sum(len(x) for _, x in want)
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append(p)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == [0, *np.cumsum([p.length for p in own])[:-1]]
        n = sum(p.length for p in own)
        assert n == length or (n < length and n & (n - 1) == 0)


def test_whole_table(spark):
    docs = storage.documents(spark, "/root/testdata/sf0.001")
    pieces = packing.pack(docs, WORDS).collect()
    check(pieces, [(r.doc_id, r.text) for r in docs.collect()], 2048)
    digests = packing.query(spark, "/root/testdata/sf0.001").collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in digests) == sorted((p.doc_id, p.start, zlib.crc32(p.ids)) for p in pieces)


def test_odd_rows_and_empty_table(spark, odd_documents, frame):
    check(packing.pack(odd_documents, WORDS, length=64).collect(), [(r.doc_id, r.text) for r in odd_documents.collect()], 64)
    assert packing.pack(frame([], "doc_id long, text string"), WORDS).count() == 0


def test_curve_steps_are_neighbours():
    side = np.arange(8)
    grid = np.stack(np.meshgrid(side, side, indexing="ij"), -1).reshape(-1, 2)
    points = np.arctanh(np.clip((grid + 0.5) / 7 * 2 - 1, -0.999, 0.999)) * packing.SPREAD
    inside = grid.max(1) < 7
    key = packing.hilbert_key(points[inside], 3)
    assert len(set(key.tolist())) == inside.sum()
    order = grid[inside][np.argsort(key)]
    steps = np.abs(np.diff(order, axis=0)).sum(1)
    assert np.median(steps) == 1


def test_powers():
    assert packing.powers(1500) == [1024, 256, 128, 64, 16, 8, 4] and packing.powers(0) == []
