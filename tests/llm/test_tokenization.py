import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from paperloom.llm import tokenization

WORDS = public_tokenizers.path("word_bpe_49k.json")
ENCODER, PLAIN = tokenization.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
PIECES = ["a", "The", "don't", "we'll", "'s", ".", ",", "...", "x.", "É", "é", "́", "İ", "K", "ς", "Σ", "ß", "漢", "９", "①", " ", " ", "\u0085", "\x1c", "\t", "\n", "\r\n", " ", "  ", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "</w>", "‍", "👍🏽", "ﬁ", "\x00", "+1", "a.b,c", "mail@x.org", "ǅ", "ʼn", "≮"]


def same(texts):
    ids, offsets = ENCODER.encode(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]
    assert got == [PLAIN.encode(t or "", add_special_tokens=False).ids for t in texts]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PIECES), max_size=12).map("".join), min_size=1, max_size=5))
def test_pieces(texts):
    same(texts)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(max_size=40), min_size=1, max_size=4))
def test_any_text(texts):
    same(texts)


def test_slices_and_memory(monkeypatch):
    monkeypatch.setattr(tokenization, "SLICE_BYTES", 64)
    monkeypatch.setattr(tokenization, "REMEMBERED_WORDS", 40)
    own = tokenization.WordEncoder(WORDS)
    rng = np.random.default_rng(1)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    texts = [" ".join(rng.choice(words, rng.integers(0, 30))) + "." for _ in range(60)] + [None, ""]
    array = pa.concat_arrays([pa.array(["left out"] * 3), pa.array(texts)]).slice(3)
    ids, offsets = own.encode(array)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == [PLAIN.encode(t or "", add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_tokenizers_encode_whole_texts(name):
    own = tokenization.WordEncoder(public_tokenizers.path(name))
    assert not own.by_word and ENCODER.by_word
    ids, offsets = own.encode(pa.array(["two  words", None]))
    assert ids.tolist() == Tokenizer.from_file(public_tokenizers.path(name)).encode("two  words", add_special_tokens=False).ids and offsets[-1] == len(ids)
