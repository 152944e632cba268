import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paperloom.llm import storage, token_archive

WORDS = public_tokenizers.path("word_bpe_49k.json")


def expected(rows, path=WORDS, end=2):
    t, start, out = Tokenizer.from_file(path), 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_whole_table_round_trip(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in storage.documents(spark, sf).collect()]
    got = sorted(tuple(r) for r in token_archive.query(spark, sf).collect())
    assert got == expected(rows)


@pytest.mark.parametrize("path", [WORDS, public_tokenizers.path("byte_bpe_50k.json")])
def test_odd_rows(spark, odd_documents, path):
    archive = token_archive.write(odd_documents, storage.fresh_path(spark, "t"), path, 2)
    got = [(r.doc_id, r.start, r.n_tokens, zlib.crc32(r.ids)) for r in token_archive.read(archive).collect()]
    want = expected([(r.doc_id, r.text) for r in odd_documents.collect()], path)
    key = lambda r: (r[1], r[2])
    assert sorted(got, key=key) == sorted(want, key=key)


def test_empty_table_and_single_document(spark, frame):
    none = frame([], "doc_id long, text string")
    assert token_archive.read(token_archive.write(none, storage.fresh_path(spark, "t"), WORDS, 2)).count() == 0
    docs = frame([(i, f"some words {i}") for i in range(50)], "doc_id long, text string")
    archive = token_archive.write(docs, storage.fresh_path(spark, "t"), WORDS, 2)
    ids = Tokenizer.from_file(WORDS).encode("some words 17", add_special_tokens=False).ids
    assert [x.tolist() for x in token_archive.read_document(archive, 17)] == [[*ids, 2]]
    row = archive.manifest.first()
    with pytest.raises(ValueError):
        token_archive.read_index(storage.read_all(f"{archive.path}/{row.file}.idx"), "11" * 32)
