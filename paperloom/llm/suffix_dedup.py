"""Removal of repeated passages: every byte covered by a string of ``LENGTH`` bytes that also starts earlier.

Earlier means in a document of smaller ``doc_id``, or in the same document at a smaller start.

1. Anchors. Each string of 100 bytes has 69 runs of 32 bytes; those of smallest hash are its anchors, the same in
   every copy of the string, wherever it lies. About one position in 35 is an anchor. An anchor's context, 68 bytes
   before it to 100 after its start, holds every string that it is an anchor of. The texts are written once, in
   blocks, to files in the shared folder, and from here on are read by address; only anchors travel.
2. Equal contexts. Anchors meet by hash. Of those with equal contexts (128 bits), the earliest stays and the others
   go with all their strings; this is done per block first, so that a passage in a third of all documents arrives
   once per block.
3. Shards. Where contexts under one anchor differ, some of their strings may still agree; the contexts must then agree
   on the 32 bytes before the anchor or on those after it, else they are left out. The earliest context of
   each kind is read and sent to a shard, all those under an anchor to the same one; a shard holds several anchors, and
   an anchor with over ``GROUP`` contexts is dealt out over several shards. A shard's bytes get a suffix array by
   Larsson and Sadakane's refinement (groups of equal prefixes are split by the rank of what follows, doubling the
   length, sorted groups left alone) and the common prefixes of neighbours by Kasai's method, all contexts in step.
   Neighbours with 100 bytes in common are copies, and the earliest of a run of them stays.
4. Shards of one anchor are merged: each sends its distinct strings as sorted 128-bit keys, which meet by key range
   and are looked up in each other by binary search; a string that another shard has earlier goes.

Memory is bounded by a block, a bucket of anchors, a shard or a range of keys, none of which grows with a group of
copies; the number of buckets follows the bytes of the table.

Nulls and odd rows: a null text is an empty one. A null id counts as the smallest. Rows of equal id are documents of
their own, in a fixed but arbitrary order, so that repeated rows are copies of each other. An empty table gives no
rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage
from .tokenization import slices

LENGTH = 100
GRAM = 32
BEFORE = LENGTH - GRAM
PAD = BEFORE + LENGTH
#: Bytes of a block of texts, of a piece that is hashed at once, and of texts per bucket of anchors.
BLOCK_BYTES = 8 << 20
PIECE_BYTES = 256 << 10
BUCKET_BYTES = 24 << 20
#: Contexts under one anchor that stay together, and bytes of a shard.
GROUP = 1024
SHARD_BYTES = 1 << 19
#: Key ranges of the merge, as a power of two, for tables of up to RANGED_BYTES; larger tables get more in proportion.
RANGE_BITS = 12
RANGED_BYTES = 64 << 30
#: Bytes of texts per partition of the later shuffles, where the session's own number would give larger ones.
PARTITION_BYTES = 256 << 20
NO_ID = -(1 << 63)

_TABLE = np.random.default_rng(1909).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = [np.uint64(x | 1) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_B, _S = np.uint64(0xFF51AFD7ED558CCD), np.uint64(31)


def _mix(x: np.ndarray) -> np.ndarray:
    x ^= x >> _S
    x *= _B
    return x


def gram_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the 32 and 64 bytes from each position; the last 63 positions are zero."""
    h, size, kept = _TABLE[data], 1, None
    for a in _A:
        nxt = np.zeros_like(h)
        if len(h) > size:
            nxt[:-size] = _mix(h[:-size] * a + h[size:])
        h, size = nxt, size * 2
        if size == GRAM:
            kept = h
    return kept, h


def _running(x: np.ndarray, best, n: int) -> np.ndarray:
    """best over x[i : i + n] for each i; the last n - 1 are zero."""
    out, size = x, 1
    while size * 2 <= n:
        nxt = np.zeros_like(out)
        nxt[:-size] = best(out[:-size], out[size:])
        out, size = nxt, size * 2
    if size < n:
        nxt = np.zeros_like(out)
        nxt[: len(out) - (n - size)] = best(out[: len(out) - (n - size)], out[n - size :])
        out = nxt
    return out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(hash, context hash, sides, text number, position) of the anchors of some texts.

    A string of 100 bytes around an anchor of 32 holds 32 bytes more on one side at least. ``sides`` are hashes of the
    anchor with the 32 bytes before it (high half) and after it (low half), of 32 bits each.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(sizes + PAD) - sizes  # a pad before each text, and one after all
    data = np.zeros(int((sizes + PAD).sum()) + PAD + 64, np.uint8)
    for t, a in zip(texts, starts.tolist()):
        data[a : a + len(t)] = np.frombuffer(t, np.uint8)
    short, wide = gram_hashes(data)
    least = _running(short, np.minimum, BEFORE + 1)
    inside = np.zeros(len(data) + 1, np.int8)  # 1 where a string of LENGTH bytes starts
    full = sizes >= LENGTH
    inside[starts[full]] += 1
    inside[(starts + sizes - LENGTH + 1)[full]] -= 1
    least[np.cumsum(inside[:-1]) == 0] = 0
    most = _running(least, np.maximum, BEFORE + 1)
    at = np.flatnonzero(short[BEFORE:] == most[: len(most) - BEFORE]) + BEFORE
    at = at[short[at] != 0]
    which = np.searchsorted(starts, at, "right") - 1
    pos = at - starts[which]
    left, right = np.minimum(pos, BEFORE), np.minimum(sizes[which] - pos, LENGTH)
    context = _mix(_mix(_mix(wide[at - BEFORE] * _A[0] + wide[at - 4]) * _A[1] + wide[at + 36]) * _A[2] + (left * 256 + right).astype(np.uint64))
    sides = (wide[at - GRAM] & ~np.uint64(0xFFFFFFFF)) | (wide[at] >> np.uint64(32))
    return short[at], context, sides, which, pos


def _pack(**columns: np.ndarray) -> dict:
    return {k: np.ascontiguousarray(v).tobytes() for k, v in columns.items()}


def _spans(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> bytes:
    """Intervals of a block's rows, joined where they touch: three runs of unsigned 32-bit numbers."""
    order = np.lexsort((b, a, rows))
    rows, a, b = rows[order], np.maximum(a[order], 0), b[order]
    # the furthest end so far within the row
    reach = np.maximum.accumulate(b + rows.astype(np.int64) * (1 << 33)) - rows.astype(np.int64) * (1 << 33)
    begins = np.ones(len(rows), bool)
    begins[1:] = (rows[1:] != rows[:-1]) | (a[1:] > reach[:-1])
    first = np.flatnonzero(begins)
    last = np.append(first[1:], len(rows)) - 1
    return b"".join(x.astype("<u4").tobytes() for x in (rows[first], a[first], reach[last]))


def _unpack_spans(data: bytes) -> np.ndarray:
    return np.frombuffer(data, "<u4").reshape(3, -1).astype(np.int64)


#: One row type for what stages tell each other: a block's spans (kind "spans"), a block's being there ("block"),
#: anchors for a bucket ("anchors"), wanted contexts ("wanted") and a shard's strings ("strings").
MESSAGE = "kind string, bucket long, file long, block int, data array<binary>"
_MESSAGE = pa.schema([("kind", pa.string()), ("bucket", pa.int64()), ("file", pa.int64()), ("block", pa.int32()), ("data", pa.list_(pa.binary()))])
_TEXTS = pa.schema([("doc_id", pa.int64()), ("text", pa.large_binary())])


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([dict(zip(_MESSAGE.names, r)) for r in rows], _MESSAGE)


def _name(path: str, file: int) -> str:
    return f"{path}/texts-{file:016x}.arrow"


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def scan(path: str, buckets: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Writes the texts by block; sends anchors, after the copies within a block have gone.

    A partition's file has the same name and content in every attempt, since what is sent names it: a task that is
    repeated after its executor was lost sends just what it sent before.
    """
    context = TaskContext.get()
    part = context.partitionId() if context else 0
    file = int.from_bytes(hashlib.sha256(f"{path}/{part}".encode()).digest()[:8], "big") >> 1
    block, sink, writer, draft = 0, None, None, f"{_name(path, file)}.{uuid.uuid4().hex}"
    for batch in (part for whole in batches for part in slices(whole, "text", BLOCK_BYTES)):
        if writer is None:
            sink = storage.open_new(draft)
            writer = pa.ipc.new_file(sink, _TEXTS, options=pa.ipc.IpcWriteOptions(compression="zstd"))
        kept = pa.RecordBatch.from_arrays([batch["doc_id"], batch["text"].cast(pa.large_binary())], schema=_TEXTS)
        writer.write_batch(kept)
        parts, base = [], 0
        for piece in slices(kept, "text", PIECE_BYTES):
            h, c, sides, row, pos = anchors(piece["text"].to_pylist())
            parts.append((h, c, sides, row + base, pos))
            base += len(piece)
        h, c, sides, row, pos = (np.concatenate(x) for x in zip(*parts))
        ids = _ids(batch["doc_id"])
        order = np.lexsort((pos, row, ids[row], c, h))
        h, c, sides, row, pos = h[order], c[order], sides[order], row[order], pos[order]
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
        out = [("block", hash((file, block)) % buckets, file, block, [])]
        if again.any():
            out.append(("spans", hash((file, block)) % buckets, file, block, [_spans(row[again], pos[again] - BEFORE, pos[again] + LENGTH)]))
        h, c, sides, row, pos = h[~again], c[~again], sides[~again], row[~again], pos[~again]
        bucket = (h % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for own in np.split(order, cuts) if len(order) else []:
            docs, which = np.unique(row[own], return_inverse=True)
            out.append(("anchors", int(bucket[own[0]]), file, block, [h[own].tobytes(), c[own].tobytes(), sides[own].tobytes(), which.astype("<u4").tobytes(), pos[own].astype("<u4").tobytes(), docs.astype("<u4").tobytes(), ids[docs].tobytes()]))
        for a in range(0, len(out), 256):
            yield _messages(out[a : a + 256])
        block += 1
    if writer is not None:
        writer.close()
        sink.close()
        storage.publish(draft, _name(path, file))


def _by_block(file: np.ndarray, block: np.ndarray) -> list[np.ndarray]:
    """Indexes of the rows of each (file, block)."""
    order = np.lexsort((block, file))
    if not len(order):
        return []
    f, b = file[order], block[order]
    return np.split(order, np.flatnonzero((f[1:] != f[:-1]) | (b[1:] != b[:-1])) + 1)


def _grouped(batches: Iterator[pa.RecordBatch], key) -> Iterator[list[dict]]:
    """Runs of rows of equal key in sorted batches."""
    own: list[dict] = []
    for batch in batches:
        for r in batch.to_pylist():
            if own and key(own[0]) != key(r):
                yield own
                own = []
            own.append(r)
    if own:
        yield own


def _shared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which pairs (a, b) come more than once."""
    order = np.lexsort((b, a))
    same = (a[order][1:] == a[order][:-1]) & (b[order][1:] == b[order][:-1])
    out = np.zeros(len(a), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bucket by bucket: spans of anchors whose context came earlier; contexts to compare under anchors with several."""
    for rows in _grouped(batches, lambda r: r["bucket"]):
        passed = [(r["kind"], 0, r["file"], r["block"], r["data"]) for r in rows if r["kind"] != "anchors"]
        for a in range(0, len(passed), 256):
            yield _messages(passed[a : a + 256])
        rows = [r for r in rows if r["kind"] == "anchors"]
        if not rows:
            continue
        cols: list[list] = [[] for _ in range(8)]
        for r in rows:
            h, c, sides, which, pos, docs, ids = (np.frombuffer(x, t) for x, t in zip(r["data"], ("<u8", "<u8", "<u8", "<u4", "<u4", "<u4", "<i8")))
            for col, x in zip(cols, (h, c, sides, ids[which], np.full(len(h), r["file"], np.int64), np.full(len(h), r["block"], np.int64), docs[which].astype(np.int64), pos.astype(np.int64))):
                col.append(x)
        del rows
        h, c, sides, ids, file, block, row, pos = (np.concatenate(x) for x in cols)
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]
        twice = np.zeros(len(h), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        at = np.flatnonzero(twice)
        at = at[np.lexsort((pos[at], row[at], block[at], file[at], ids[at], c[at], h[at]))]
        h, c, sides, ids, file, block, row, pos = (x[at] for x in (h, c, sides, ids, file, block, row, pos))
        again = np.zeros(len(h), bool)
        again[1:] = (h[1:] == h[:-1]) & (c[1:] == c[:-1])
        out = []
        gone = np.flatnonzero(again)
        for own in _by_block(file[gone], block[gone]):
            own = gone[own]
            out.append(("spans", 0, int(file[own[0]]), int(block[own[0]]), [_spans(row[own], pos[own] - BEFORE, pos[own] + LENGTH)]))
        first = np.flatnonzero(~again)
        several = _shared(h[first], sides[first] >> np.uint64(32)) | _shared(h[first], sides[first] & np.uint64(0xFFFFFFFF))
        first = first[several]
        _, number, size = np.unique(h[first], return_inverse=True, return_counts=True)
        size = size[number]
        for own in _by_block(file[first], block[first]):
            i = first[own]
            out.append(("wanted", 0, int(file[i[0]]), int(block[i[0]]), [h[i].tobytes(), size[own].astype("<u4").tobytes(), ids[i].tobytes(), row[i].astype("<u4").tobytes(), pos[i].astype("<u4").tobytes()]))
        for a in range(0, len(out), 256):
            yield _messages(out[a : a + 256])


CONTEXTS = "anchor long, salt int, doc_id long, file long, block int, row int, start int, bytes binary"
_CONTEXTS = pa.schema([("anchor", pa.int64()), ("salt", pa.int32()), ("doc_id", pa.int64()), ("file", pa.int64()), ("block", pa.int32()), ("row", pa.int32()), ("start", pa.int32()), ("bytes", pa.binary())])


def _blocks(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, pa.RecordBatch, list[dict]]]:
    """(file, block, its texts, the messages about it) for sorted messages."""
    opened, reader, source = None, None, None
    for rows in _grouped(batches, lambda r: (r["file"], r["block"])):
        file, block = rows[0]["file"], rows[0]["block"]
        if opened != file:
            if source is not None:
                source.close()
            source = storage.open_at(_name(path, file))
            opened, reader = file, pa.ipc.open_file(source)
        yield file, block, reader.get_batch(block), rows
    if source is not None:
        source.close()


def fetch(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the wanted contexts."""
    for file, block, texts, rows in _blocks(path, batches):
        text = texts["text"]
        for r in rows:
            h, size, ids, row, pos = (np.frombuffer(x, t) for x, t in zip(r["data"], ("<i8", "<u4", "<i8", "<u4", "<u4")))
            start = np.maximum(pos.astype(np.int64) - BEFORE, 0)
            salts = -(-size.astype(np.int64) // GROUP)
            spread = ((ids * 31 + row) * 31 + pos) % np.maximum(salts, 1)
            salt = np.where(salts > 1, spread, -1)
            order = np.argsort(row, kind="stable")
            data: list = [None] * len(h)
            last, own = -1, b""
            for i in order.tolist():
                if row[i] != last:
                    last, own = row[i], text[int(row[i])].as_py()
                data[i] = own[start[i] : int(pos[i]) + LENGTH]
            for a in range(0, len(h), 4000):
                n = len(h[a : a + 4000])
                yield pa.RecordBatch.from_arrays([pa.array(h[a : a + n]), pa.array(salt[a : a + n].astype(np.int32)), pa.array(ids[a : a + n]), pa.array(np.full(n, file, np.int64)), pa.array(np.full(n, block, np.int32)), pa.array(row[a : a + n].astype(np.int32)), pa.array(start[a : a + n].astype(np.int32)), pa.array(data[a : a + n], pa.binary())], schema=_CONTEXTS)


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each position as a big-endian number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for j in range(8):
        out = (out << np.uint64(8)) | padded[j : j + len(data)]
    return out


def suffix_array(data: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, group of each position) by the first ``depth`` bytes, by Larsson and Sadakane's refinement.

    A position's group is the place of the first suffix that has the same ``depth`` bytes. ``depth`` is 8 at least.
    """
    n, key = len(data), words_at(data)
    order = np.argsort(key)
    begins = np.ones(n, bool)
    begins[1:] = key[order][1:] != key[order][:-1]
    for i in range(max(0, n - 7), n)[::-1]:  # a suffix that ends within its word comes before real zeros
        same = np.flatnonzero(key[order] == key[i])
        own = order[same]
        order[same] = own[np.argsort(np.minimum(n - own, 8), kind="stable")]
        left = np.minimum(n - order[same], 8)
        begins[same[1:]] = left[1:] != left[:-1]
    group = np.empty(n, np.int64)
    group[order] = np.maximum.accumulate(np.where(begins, np.arange(n), 0))
    length = 8
    while length < depth:
        step = min(length, depth - length)
        alone = begins & np.append(begins[1:], True)
        at = np.flatnonzero(~alone)  # places in groups of two and more; sorted groups stay as they are
        if not len(at):
            break
        own = order[at]
        after = np.where(own + step < n, group[np.minimum(own + step, n - 1)], -1)
        both = group[own] * (n + 1) + after + 1
        again = np.argsort(both)
        own, both = own[again], both[again]
        order[at] = own
        head = np.ones(len(own), bool)
        head[1:] = both[1:] != both[:-1]
        begins[at] = head
        group[own] = np.maximum.accumulate(np.where(head, at, 0))
        length += step
    return order, group


def common_prefixes(data: np.ndarray, order: np.ndarray, lanes: np.ndarray, group: np.ndarray | None = None, depth: int = LENGTH) -> np.ndarray:
    """For each position, the bytes (``depth`` at most) that it shares with the suffix before it in ``order``.

    Kasai's method: from one position to the next the number falls by one at most, so that comparing resumes there.
    ``lanes`` are the starts of stretches (ascending, the first is 0); all stretches advance in step. Where the last
    number was cut at ``depth``, the order beyond is not known and comparing starts anew. Neighbours that ``group``
    says agree on all of ``depth`` need no comparing.
    """
    n, words = len(data), words_at(data)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    ends = np.append(lanes[1:], n)
    shared = np.zeros(n, np.int64)
    last = np.zeros(len(lanes), np.int64)
    for t in range(int((ends - lanes).max()) if len(lanes) else 0):
        live = np.flatnonzero(lanes + t < ends)
        i = lanes[live] + t
        j = before[i]
        l = np.where(last[live] < depth, np.maximum(last[live] - 1, 0), 0)  # noqa: E741
        l[j < 0] = 0
        if group is None:
            open_ = np.flatnonzero(j >= 0)
        else:
            same = (j >= 0) & (group[i] == group[j])
            l[same] = depth
            open_ = np.flatnonzero((j >= 0) & ~same)
        while len(open_):
            a, b = i[open_] + l[open_], j[open_] + l[open_]
            ok = (a < n) & (b < n) & (l[open_] < depth)
            open_, a, b = open_[ok], a[ok], b[ok]
            differs = words[a] ^ words[b]
            # equal leading bytes of the two words; a float's exponent gives the highest set bit
            bits = np.frexp((differs >> np.uint64(11)).astype(np.float64))[1]
            same = np.where(differs == 0, 8, np.where(bits > 0, (53 - bits) // 8, np.where(differs >= 1 << 8, 6, 7)))
            l[open_] += np.minimum(same, n - np.maximum(a, b))
            open_ = open_[same == 8]
        l = np.minimum(l, depth)  # noqa: E741
        shared[i] = l
        last[live] = l
    return shared


def _string_keys(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit keys of the strings of LENGTH bytes at these positions."""
    _, wide = gram_hashes(np.concatenate([data, np.zeros(64, np.uint8)]))
    a, b = wide[at], wide[at + LENGTH - 64]
    return _mix(a * _A[3] + b), _mix(b * _A[4] + _mix(a * _A[5]))


def _shard(rows: list[pa.RecordBatch], bits: int = RANGE_BITS) -> Iterator[tuple]:
    """Messages of one shard: spans of strings with an earlier copy in it; the distinct strings of dealt-out anchors."""
    table = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
    ids, file, block, row, start, salt = (table[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "file", "block", "row", "start", "salt"))
    contexts = table["bytes"].to_pylist()
    sizes = np.array([len(x) for x in contexts], np.int64)
    data = np.frombuffer(b"".join(contexts), np.uint8)
    lanes = np.cumsum(sizes) - sizes
    order, group = suffix_array(data)
    shared = common_prefixes(data, order, lanes, group)
    of = np.repeat(np.arange(len(sizes)), sizes)
    offset = np.arange(len(data)) - lanes[of]
    whole = sizes[of] - offset >= LENGTH
    run = np.cumsum(np.concatenate([[1], (shared[order[1:]] < LENGTH).astype(np.int64)]))
    at = order[whole[order]]
    run = run[whole[order]]
    # a string's place: its document's rank in the shard, then its start
    ranked = np.lexsort((row, block, file, ids))
    changes = np.ones(len(ranked), np.int64)
    changes[1:] = (ids[ranked][1:] != ids[ranked][:-1]) | (file[ranked][1:] != file[ranked][:-1]) | (block[ranked][1:] != block[ranked][:-1]) | (row[ranked][1:] != row[ranked][:-1])
    rank = np.empty(len(ranked), np.int64)
    rank[ranked] = np.cumsum(changes)
    place = rank[of[at]] * (1 << 32) + start[of[at]] + offset[at]
    by = np.lexsort((place, run))
    at, run, place = at[by], run[by], place[by]
    heads = np.ones(len(at), bool)
    heads[1:] = run[1:] != run[:-1]
    first = np.maximum.accumulate(np.where(heads, np.arange(len(at)), 0))
    gone = place != place[first]
    lost = at[gone]
    for own in _by_block(file[of[lost]], block[of[lost]]):
        p = lost[own]
        begin = start[of[p]] + offset[p]
        yield "spans", 0, int(file[of[p[0]]]), int(block[of[p[0]]]), [_spans(row[of[p]], begin, begin + LENGTH)]
    keep = at[heads]
    keep = keep[salt[of[keep]] >= 0]
    if len(keep):
        k1, k2 = _string_keys(data, keep)
        by = np.lexsort((k2, k1))
        keep, k1, k2 = keep[by], k1[by], k2[by]
        ranges = (k1 >> np.uint64(64 - bits)).astype(np.int64)
        for own in np.split(np.arange(len(keep)), np.flatnonzero(np.diff(ranges)) + 1):
            p = keep[own]
            yield "strings", int(ranges[own[0]]), 0, 0, [x.tobytes() for x in (k1[own], k2[own], ids[of[p]], file[of[p]], block[of[p]], row[of[p]], start[of[p]] + offset[p])]


def compare(bits: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Suffix arrays of shards of contexts, which come sorted by anchor and salt."""
    own: list[pa.RecordBatch] = []
    size, last = 0, None

    def flush() -> Iterator[pa.RecordBatch]:
        out = list(_shard(own, bits))
        for a in range(0, len(out), 256):
            yield _messages(out[a : a + 256])

    for batch in batches:
        key = np.stack([batch["anchor"].to_numpy(), batch["salt"].to_numpy().astype(np.int64)])
        cuts = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            if a == b:
                continue
            here = tuple(key[:, a])
            if here != last and own and size >= SHARD_BYTES:
                yield from flush()
                own, size = [], 0
            last = here
            own.append(batch.slice(a, b - a))
            size += PAD * (b - a)
    if own:
        yield from flush()


def merged_runs(runs: list[list[np.ndarray]]) -> list[np.ndarray]:
    """One run from sorted runs of columns, by their first: two at a time, the places of the one's keys in the other
    found by binary search. Equal keys keep the order of the runs."""
    while len(runs) > 1:
        out = []
        for a, b in zip(runs[::2], runs[1::2]):
            at = np.searchsorted(a[0], b[0], "right") + np.arange(len(b[0]))
            first = np.ones(len(a[0]) + len(b[0]), bool)
            first[at] = False
            both = [np.empty(len(first), x.dtype) for x in a]
            for whole, x, y in zip(both, a, b):
                whole[first], whole[at] = x, y
            out.append(both)
        runs = out + runs[len(runs) // 2 * 2 :]
    return runs[0]


def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key range by key range: the strings of dealt-out anchors that another shard has earlier."""
    for rows in _grouped(batches, lambda r: r["bucket"]):
        k1, k2, ids, file, block, row, start = merged_runs([[np.frombuffer(x, t) for x, t in zip(r["data"], ("<u8", "<u8", *["<i8"] * 5))] for r in rows])
        same = np.zeros(len(k1), bool)
        same[1:] = k1[1:] == k1[:-1]
        at = np.flatnonzero(same | np.append(same[1:], False))  # only strings that meet another of their key
        at = at[np.lexsort((start[at], row[at], block[at], file[at], ids[at], k2[at], k1[at]))]
        k1, k2, file, block, row, start = (x[at] for x in (k1, k2, file, block, row, start))
        heads = np.ones(len(at), bool)
        heads[1:] = (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])
        first = np.maximum.accumulate(np.where(heads, np.arange(len(at)), 0))
        gone = np.flatnonzero((file != file[first]) | (block != block[first]) | (row != row[first]) | (start != start[first]))
        out = []
        for own in _by_block(file[gone], block[gone]):
            p = gone[own]
            out.append(("spans", 0, int(file[p[0]]), int(block[p[0]]), [_spans(row[p], start[p], start[p] + LENGTH)]))
        for a in range(0, len(out), 256):
            yield _messages(out[a : a + 256])


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept", pa.binary())])


def cut(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Block by block, the texts without their spans."""
    for _, _, texts, rows in _blocks(path, batches):
        found = [_unpack_spans(r["data"][0]) for r in rows if r["kind"] == "spans"]
        if found:
            row, a, b = np.concatenate(found, 1)
            row, a, b = _unpack_spans(_spans(row, a, b))
        else:
            row = a = b = np.zeros(0, np.int64)
        bounds = np.searchsorted(row, np.arange(len(texts) + 1)).tolist()
        a, b = a.tolist(), b.tolist()
        for lo in range(0, len(texts), 500):
            out = []
            for i in range(lo, min(lo + 500, len(texts))):
                text = texts["text"][i].as_py()
                parts, at, removed = [], 0, 0
                for s in range(bounds[i], bounds[i + 1]):
                    end = min(b[s], len(text))
                    parts.append(text[at : a[s]])
                    removed, at = removed + end - a[s], end
                parts.append(text[at:])
                out.append({"doc_id": texts["doc_id"][i].as_py(), "n_bytes": len(text), "n_removed": removed, "n_spans": bounds[i + 1] - bounds[i], "kept": b"".join(parts)})
            yield pa.RecordBatch.from_pylist(out, _RESULT)


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): each document's text as UTF-8 without its repeated passages."""
    spark = docs.sparkSession
    path = storage.fresh_path(spark, "passage-texts")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.encode(storage.text_or_empty(), "UTF-8").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(16, -(-total // BUCKET_BYTES))
    sent = storage.in_arrow(rows, partial(scan, path, buckets), MESSAGE)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PARTITION_BYTES))
    bits = RANGE_BITS + max(0, (total // RANGED_BYTES).bit_length())
    by_bucket = sent.repartition(max(partitions, min(buckets, 4 * partitions)), "bucket").sortWithinPartitions("bucket")
    met = storage.staged(storage.in_arrow(by_bucket, meet, MESSAGE), "passage-messages")
    wanted = met.filter("kind = 'wanted'").repartition(partitions, "file", "block").sortWithinPartitions("file", "block")
    contexts = storage.in_arrow(wanted, partial(fetch, path), CONTEXTS)
    shards = contexts.repartition(2 * partitions, "anchor", "salt").sortWithinPartitions("anchor", "salt")
    compared = storage.staged(storage.in_arrow(shards, partial(compare, bits), MESSAGE), "passage-shards")
    strings = compared.filter("kind = 'strings'").repartition(partitions, "bucket").sortWithinPartitions("bucket")
    merged = storage.in_arrow(strings, merge, MESSAGE)
    spans = met.filter("kind IN ('block', 'spans')").unionByName(compared.filter("kind = 'spans'")).unionByName(merged)
    return storage.in_arrow(spans.repartition(partitions, "file", "block").sortWithinPartitions("file", "block"), partial(cut, path), RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: every document's repeated passages."""
    out = dedup(storage.documents(spark, sf_dir))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

