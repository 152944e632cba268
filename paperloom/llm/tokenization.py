"""Token ids of many texts at once, through the tokenizers library.

A tokenizer that drops white space and never joins across it gives a text the ids of its words one after the other.
For such a tokenizer each distinct word of a batch goes through the library once; the ids of all texts are then
gathered with numpy. Any other tokenizer encodes whole texts.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words remembered by one Python worker; it only saves work. When it is full, words met in one slice only go.
REMEMBERED_WORDS = 500_000
#: Bytes of text that are worked on at once; a longer text is one slice.
SLICE_BYTES = 4 << 20

_loaded: dict[str, WordEncoder] = {}


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose texts have about ``most`` bytes."""
    ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))])
    a = 0
    while a < len(batch):
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + most, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _plain(texts: pa.Array) -> pa.Array:
    """The texts with A-Z lower-cased and a space before a full stop or comma that ends a word of letters.

    The tokenizer lower-cases anyway, and parts letters from such a mark; fewer distinct words remain.
    """
    n = len(texts)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    data = _LOWER[np.frombuffer(texts.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]]
    if len(data) > 2:
        letter = (data >= 97) & (data <= 122)
        mark = ((data == 44) | (data == 46))[1:-1] & letter[:-2] & _SPACE[data[2:]]
        at = np.flatnonzero(mark) + 1
        wide = np.repeat(data, 1 + np.bincount(at, minlength=len(data)))
        wide[at + np.arange(len(at))] = 32
        ends = ends - ends[0]
        ends = ends + np.searchsorted(at, ends, "left")
        data = wide
    else:
        ends = ends - ends[0]
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer(np.ascontiguousarray(ends).tobytes()), pa.py_buffer(data.tobytes()))


def _drops_white_space(spec: dict) -> bool:
    """Whether the tokenizer removes all white space between its pieces."""
    pre = spec.get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers", [pre])
    if spec.get("post_processor") or spec.get("truncation") or spec.get("padding"):
        return False
    if any(t.get("lstrip") or t.get("rstrip") or any(c.isspace() for c in t["content"]) for t in spec.get("added_tokens", [])):
        return False
    lowers = any(n.get("type") == "Lowercase" for n in (spec.get("normalizer") or {}).get("normalizers", []))
    return lowers and any(  # letters apart from marks, white space in neither
        p.get("type") == "Split" and p.get("behavior") == "Removed" and p.get("invert") and all(x in p["pattern"].get("Regex", "") for x in ("|[\\p{L}]+|", "|[^\\s\\p{L}\\p{N}]+"))
        for p in parts
    )


class WordEncoder:
    """Encodes arrays of texts: ``encode(texts) -> (ids as uint32, offsets)``."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_word = _drops_white_space(spec)
        suffix, self.ends_word = spec["model"].get("end_of_word_suffix"), None
        if self.by_word and suffix:  # which ids end a word
            vocabulary = self.tokenizer.get_vocab()
            self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends_word[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.store = np.zeros(1 << 16, np.uint32)
        self.first = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int64)
        self.met = np.zeros(1 << 12, np.int64)
        self.used = 0

    def _shrink(self) -> None:
        """Forgets the words met in one slice only, or all if most were met again."""
        words = np.array(list(self.place), dtype=object)
        keep = np.flatnonzero(self.met[: len(words)] > 1)
        if len(keep) > REMEMBERED_WORDS // 2:
            return self._forget()
        lengths = self.count[keep]
        ends = np.cumsum(lengths)
        first = ends - lengths
        at = np.repeat(self.first[keep] - first, lengths) + np.arange(int(lengths.sum()))
        self.store[: len(at)] = self.store[at]
        self.used = len(at)
        self.first[: len(keep)], self.count[: len(keep)] = first, lengths
        self.met[:] = 0
        self.place = dict(zip(words[keep].tolist(), range(len(keep))))

    def _encode_letters(self, words: list[str]) -> list | None:
        """The ids of words of letters alone, encoded as one text; None if they can't be told apart in it."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int64)
        ends = np.flatnonzero(self.ends_word[ids]) + 1
        if len(ends) != len(words) or ends[-1] != len(ids):
            return None
        bounds, ids = [0, *ends.tolist()], ids.tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:])]

    def _learn(self, words: list[str]) -> None:
        letters = [w for w in words if w.isalpha()] if self.ends_word is not None else []
        ids: list = []
        for a in range(0, len(letters), 1000):
            own = letters[a : a + 1000]
            ids += self._encode_letters(own) or [e.ids for e in self.tokenizer.encode_batch_fast(own, add_special_tokens=False)]
        others = [w for w in words if not w.isalpha()] if letters else words
        ids += [e.ids for e in self.tokenizer.encode_batch_fast(others, add_special_tokens=False)]
        words = letters + others
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum()))
        known, total = len(self.place), len(self.place) + len(words)
        while self.used + len(flat) > len(self.store):
            self.store = np.concatenate([self.store, np.zeros_like(self.store)])
        while total > len(self.first):
            self.first = np.concatenate([self.first, np.zeros_like(self.first)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
            self.met = np.concatenate([self.met, np.zeros_like(self.met)])
        self.store[self.used : self.used + len(flat)] = flat
        self.first[known:total] = self.used + np.cumsum(lengths) - lengths
        self.count[known:total] = lengths
        self.used += len(flat)
        self.place.update(zip(words, range(known, total)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_word:
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)]
            lengths = np.fromiter(map(len, ids), np.int64, len(ids))
            return np.fromiter((i for x in ids for i in x), np.uint32, int(lengths.sum())), np.concatenate([[0], np.cumsum(lengths)])
        ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        parts, offsets, a = [], [np.zeros(1, np.int64)], 0
        while a < len(texts):
            b = max(a + 1, int(np.searchsorted(ends, ends[a] + SLICE_BYTES, "right")) - 1)
            ids, bounds = self._encode_words(texts.slice(a, b - a))
            parts.append(ids)
            offsets.append(bounds[1:] + offsets[-1][-1])
            a = b
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), np.concatenate(offsets)

    def _encode_words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not pc.any(pc.match_substring(texts, "<|")).as_py():  # else a special token's name could come to be or fall apart
            texts = _plain(texts)
        split = pc.ascii_split_whitespace(texts)
        bounds = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
        coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds -= bounds[0]
        words = coded.dictionary.to_pylist()
        if len(self.place) + len(words) > REMEMBERED_WORDS:
            self._shrink()
        known = self.place.get
        of_word = np.fromiter([known(w, -1) for w in words], np.int64, len(words))
        new = np.flatnonzero(of_word < 0)
        if len(new):
            self._learn([words[i] for i in new])
            of_word[new] = [self.place[words[i]] for i in new]
        self.met[of_word] += 1
        which = of_word[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.int64)
        lengths = self.count[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        shift = np.repeat(self.first[which] - (ends - lengths), lengths)
        ids = self.store[shift + np.arange(total)]
        return ids, np.concatenate([[0], ends])[bounds]


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _loaded:
        _loaded[path] = WordEncoder(path)
    return _loaded[path]


def with_end(ids: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after each text."""
    n = len(offsets) - 1
    out = np.empty(len(ids) + n, np.uint32)
    ends = offsets[1:] + np.arange(n)
    keep = np.ones(len(out), bool)
    keep[ends] = False
    out[keep] = ids
    out[ends] = end_id
    return out, offsets + np.arange(n + 1)
