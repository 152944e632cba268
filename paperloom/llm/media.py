"""Media columns: chroma fingerprints of audio, and recordings aligned by them.

A recording is a column of bytes: a WAV file, or bare unsigned 8-bit samples. Its spectrum's power is summed into
twelve pitch classes per frame; filters over a window of frames (sums over areas, read off an integral image) are
quantized to two bits each and packed into one 32-bit integer per window.

Alignment: recordings with equal fingerprints collapse first. Every two neighbouring integers are a key; each recording
that holds a key is compared with the first recording that holds it, which ties most of a group together; then all
other pairs that share a key across the groups found so far are compared where they meet, over the whole common stretch
at that offset, so that no group falls apart by what its first holder is and only aligned couples are written. For each
couple the fullest offset wins (the one at which most keys agree; across groups, of the offsets that are aligned), and at
that offset the share of differing bits over the common stretch decides. Linked recordings form a group, named by its
smallest id.

Nulls and odd rows: null, empty and short recordings have no integers and are alone unless they are equal; bytes that
look like a WAV file and are none are taken as samples. Null ids never name a group unless it has no ids at all (then
the group is null). Ids are below 2**62. Repeated rows are kept. An empty table gives no rows. Extra columns are
ignored.
"""

from __future__ import annotations

import io
import wave
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import storage
from .components import connected_components
from .tokenization import slices

RATE = 8000
FRAME = 256
HOP = 64
#: Frames of a filter window, and the band whose power counts.
WINDOW = 12
BAND = (100.0, 3500.0)
#: Filter values between which the two bits change.
LEVELS = (-0.06, 0.0, 0.06)
#: Bits that may differ and integers that must be common for recordings to be aligned.
BIT_ERRORS = 0.15
LEAST_COMMON = 4
#: Share of the shorter recording that the common stretch must cover.
COVER = 0.5
#: Holders of one key that meet at once; more are dealt over tasks in blocks of about as many.
HOLDERS = 1000
#: Couples and integers that are compared at once.
COUPLES = 1 << 19
COMPARED = 1 << 21
NO_ID = 1 << 62
SLICE_BYTES = 1 << 20


def samples(data: bytes | None) -> np.ndarray:
    """The recording's samples from -1 to 1, as one channel."""
    data = data or b""
    if data[:4] == b"RIFF" and data[8:12] == b"WAVE":
        try:
            with wave.open(io.BytesIO(data)) as f:
                raw, width, channels = f.readframes(f.getnframes()), f.getsampwidth(), f.getnchannels()
            if width in (1, 2) and channels:
                x = np.frombuffer(raw[: len(raw) // (width * channels) * width * channels], np.uint8 if width == 1 else "<i2").astype(np.float32)
                return ((x - 128) / 128 if width == 1 else x / 32768).reshape(-1, channels).mean(1)
        except (wave.Error, EOFError):
            pass
    return (np.frombuffer(data, np.uint8).astype(np.float32) - 128) / 128


def pitch_classes() -> np.ndarray:
    """(bin, class): which of twelve classes each spectrum bin in the band belongs to."""
    hertz = np.arange(FRAME // 2 + 1) * RATE / FRAME
    out = np.zeros((len(hertz), 12), np.float32)
    inside = np.flatnonzero((hertz >= BAND[0]) & (hertz <= BAND[1]))
    out[inside, np.round(12 * np.log2(hertz[inside] / 440.0)).astype(int) % 12] = 1
    return out


def filter_bank() -> list[tuple[list[tuple[int, int, int, int]], list[tuple[int, int, int, int]]]]:
    """(positive areas, negative areas) of each filter; an area is (first frame, end frame, first class, end class).

    Two widths and two ranges of classes, each with four contrasts: between halves of the range, between halves of the
    time, crosswise between both, and between the middle of the time and its sides.
    """
    bank = []
    for width in (WINDOW, WINDOW // 2):
        for low, high in ((0, 6), (5, 11)):  # not all twelve, whose sum is the same in every frame
            mid, half, third = (low + high) // 2, width // 2, width // 3
            bank.append(([(0, width, low, mid)], [(0, width, mid, high)]))
            bank.append(([(0, half, low, high)], [(half, width, low, high)]))
            bank.append(([(0, half, low, mid), (half, width, mid, high)], [(0, half, mid, high), (half, width, low, mid)]))
            bank.append(([(third, width - third, low, high)], [(0, third, low, high), (width - third, width, low, high)]))
    return bank


def fingerprints(recordings: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(all packed integers, bounds of the recordings in them)."""
    sizes = np.array([len(x) for x in recordings], np.int64)
    frames = np.maximum((sizes - FRAME) // HOP + 1, 0)
    counts = np.maximum(frames - WINDOW + 1, 0)
    frames = np.where(counts > 0, frames, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    total = int(frames.sum())
    if not total:
        return np.zeros(0, np.uint32), bounds
    data = np.concatenate(recordings)
    first = np.cumsum(frames) - frames
    start = np.repeat(np.cumsum(sizes) - sizes - first * HOP, frames) + np.arange(total) * HOP
    shape, classes = np.hanning(FRAME).astype(np.float32), pitch_classes()
    chroma = np.empty((total, 12), np.float32)
    for a in range(0, total, 2048):
        part = data[start[a : a + 2048, None] + np.arange(FRAME)]
        part = (part - part.mean(1, keepdims=True)) * shape
        spectrum = np.fft.rfft(part, axis=1)
        power = spectrum.real**2 + spectrum.imag**2
        chroma[a : a + 2048] = power @ classes
    chroma /= np.maximum(chroma.sum(1, keepdims=True), 1e-9)
    integral = np.zeros((total + 1, 13))
    integral[1:, 1:] = chroma.cumsum(0, dtype=np.float64).cumsum(1)
    at = np.repeat(first - bounds[:-1], counts) + np.arange(int(counts.sum()))

    def area(f0: int, f1: int, c0: int, c1: int) -> np.ndarray:
        both = integral[:, c1] - integral[:, c0]
        return both[at + f1] - both[at + f0]

    out = np.zeros(len(at), np.uint32)
    for plus, minus in filter_bank():
        size = lambda areas: sum((f1 - f0) * (c1 - c0) for f0, f1, c0, c1 in areas)
        value = np.log1p(12 * sum(area(*x) for x in plus) / size(plus)) - np.log1p(12 * sum(area(*x) for x in minus) / size(minus))
        step = np.searchsorted(LEVELS, np.round(value, 6), "right")
        out = (out << np.uint32(2)) | np.array([0, 1, 3, 2], np.uint32)[step]
    return out, bounds


FINGERPRINTS = "id long, c1 long, c2 long, ints binary"


def _fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in (part for whole in batches for part in slices(whole, "payload", SLICE_BYTES)):
        ints, bounds = fingerprints([samples(x) for x in batch["payload"].to_pylist()])
        raw, ends = ints.astype("<u4").tobytes(), (bounds * 4).tolist()
        own = [raw[a:b] for a, b in zip(ends, ends[1:])]
        # recordings without integers are equal if their bytes are
        names = np.frombuffer(b"".join(xxhash.xxh128_digest(x or b"bare" + (p or b"")) for x, p in zip(own, batch["payload"].to_pylist())), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([batch["id"], pa.array(names[:, 0].copy()), pa.array(names[:, 1].copy()), pa.array(own, pa.binary())], names=["id", "c1", "c2", "ints"])


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, at, before): the first place of every pair of neighbouring integers in a recording, and the integer
    before it; -1 where there is none, or where the pair that begins with it has an earlier place."""
    for batch in batches:
        for a in range(0, len(batch), 500):
            keys, nodes, places, earlier = [], [], [], []
            for node, raw in zip(batch["node"][a : a + 500].to_pylist(), batch["ints"][a : a + 500].to_pylist()):
                x = np.frombuffer(raw, "<u4").astype(np.uint64)
                if len(x) > 1:
                    key, at = np.unique((x[:-1] << np.uint64(32)) | x[1:], return_index=True)
                    keys.append(key.view(np.int64))
                    places.append(at.astype(np.int32))
                    nodes.append(np.full(len(key), node, np.int64))
                    before = np.full(len(x), -1, np.int64)
                    before[at + 1] = x[at]
                    earlier.append(before[at])
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (keys, nodes, places, earlier)], names=["key", "node", "at", "before"])


def bit_error(a: np.ndarray, b: np.ndarray, offset: int) -> tuple[float, int]:
    """(share of differing bits, common integers) with ``b`` moved by ``offset``: b[i + offset] goes with a[i]."""
    lo, hi = max(0, -offset), min(len(a), len(b) - offset)
    if hi <= lo:
        return 1.0, 0
    return float(np.bitwise_count(a[lo:hi] ^ b[lo + offset : hi + offset]).sum()) / (32 * (hi - lo)), hi - lo


def _aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for u, v, offset, iu, iv in zip(*(batch[c].to_pylist() for c in ("u", "v", "offset", "iu", "iv"))):
            error, common = bit_error(np.frombuffer(iu, "<u4"), np.frombuffer(iv, "<u4"), offset)
            if error <= BIT_ERRORS and common >= max(LEAST_COMMON, COVER * min(len(iu), len(iv)) / 4):
                rows.append({"u": u, "v": v, "offset": offset, "bit_error": error})
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("u", pa.int64()), ("v", pa.int64()), ("offset", pa.int32()), ("bit_error", pa.float64())]))


def compared(met: DataFrame, nodes: DataFrame) -> DataFrame:
    """(u, v, offset, bit_error) of the couples ``met(u, v, offset, n)``, n keys agreeing at an offset, that are aligned
    at their fullest offset."""
    best = met.groupBy("u", "v").agg(F.max(F.struct("n", -F.abs("offset"), "offset")).alias("best")).select("u", "v", F.col("best.offset").alias("offset"))
    ints = nodes.select("node", "ints")
    pairs = best.join(ints.select(F.col("node").alias("u"), F.col("ints").alias("iu")), "u").join(ints.select(F.col("node").alias("v"), F.col("ints").alias("iv")), "v")
    return storage.staged(storage.in_arrow(pairs.select("u", "v", "offset", "iu", "iv"), _aligned, "u long, v long, offset int, bit_error double"), "alignments")


def _pieces(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs whose sizes add up to ``most`` at most; a larger one is a run of its own."""
    ends, a = np.cumsum(sizes), 0
    while a < len(sizes):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + most, "right")))
        yield a, b
        a = b


def _runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """first, first + 1, ... as many as its size says, for each."""
    return np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def _couples(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """(u, v, offset, n) of the aligned couples among rows of whole cells; n keys agree there."""
    key, cell, within, block, node, component, at = (rows[c].to_numpy() for c in ("key", "cell", "within", "block", "node", "component", "at"))
    raw = rows["ints"].to_pylist()
    x, size = np.frombuffer(b"".join(raw), "<u4"), np.array([len(r) // 4 for r in raw], np.int64)
    at, bounds, own = at.astype(np.int64), np.cumsum(size) - size, np.arange(len(key))
    start = np.maximum.accumulate(np.where(np.concatenate([[True], (key[1:] != key[:-1]) | (cell[1:] != cell[:-1])]), own, 0))
    for a, b in _pieces(own - start, COUPLES):
        i, j = np.repeat(own[a:b], (own - start)[a:b]), _runs(start[a:b], (own - start)[a:b])
        lo = np.minimum(at[i], at[j])
        stretch = lo + np.minimum(size[i] - at[i], size[j] - at[j])
        met = (component[i] != component[j]) & (within[i] | (block[i] != block[j])) & (stretch >= np.maximum(LEAST_COMMON, COVER * np.minimum(size[i], size[j])))
        i, j, lo, stretch = i[met], j[met], lo[met], stretch[met]
        for c, d in _pieces(stretch, COMPARED):
            u, v, m = i[c:d], j[c:d], stretch[c:d]
            bits = np.bitwise_count(x[_runs(bounds[u] + at[u] - lo[c:d], m)] ^ x[_runs(bounds[v] + at[v] - lo[c:d], m)])
            first = np.cumsum(m) - m
            good = np.add.reduceat(bits, first, dtype=np.int64) / (32 * m) <= BIT_ERRORS
            if good.any():
                agree = np.append((bits[:-1] == 0) & (bits[1:] == 0), False)
                agree[first[1:] - 1] = False  # of two couples
                n = np.add.reduceat(agree, first, dtype=np.int64)[good]
                u, v = u[good], v[good]
                u, v = np.where(node[u] > node[v], u, v), np.where(node[u] > node[v], v, u)
                yield pa.RecordBatch.from_arrays([pa.array(node[u]), pa.array(node[v]), pa.array((at[v] - at[u]).astype(np.int32)), pa.array(n)], names=["u", "v", "offset", "n"])


def _meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_couples`` of rows that come in order of their cells; a cell that goes on in the next batch waits for it."""
    waiting = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        rows = rows if waiting is None else pa.concat_tables([waiting, rows])
        key, cell = rows["key"].to_numpy(), rows["cell"].to_numpy()
        ends = np.flatnonzero((key[1:] != key[:-1]) | (cell[1:] != cell[:-1])) + 1
        cut = int(ends[-1]) if len(ends) else 0
        waiting = rows.slice(cut)
        if cut:
            yield from _couples(rows.slice(0, cut))
    if waiting is not None and len(waiting):
        yield from _couples(waiting)


def across(shared: DataFrame, nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """(u, v, offset, n) for the recordings of different components that share a key, at an offset of which they are
    aligned; n keys agree there. ``shared(key, node, at, before)``, ``parts(node, component)``.

    A key whose holders all have the same key right before it is left out: whatever meets under it meets there, at the
    same offset. The holders of a key meet in cells of two blocks of about HOLDERS, each a task's work; they bring their
    integers, so that couples are decided there, over their whole stretch, and none but those aligned are written.
    """
    component = F.coalesce("component", "node").alias("component")
    own = shared.join(parts, "node", "left").select("key", "node", "at", "before", component)
    found = own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("before").alias("least"), F.max("before").alias("most"), F.ceil(F.count("*") / HOLDERS).cast("int").alias("blocks"))
    mixed = found.filter("low < high AND (least < 0 OR least < most)").select("key", "blocks")
    held = own.join(mixed, "key").withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = held.select("key", "node", "at", "component", "block", "blocks", F.explode(F.expr("sequence(0, blocks - 1)")).alias("other"))
    cell = F.least("block", "other") * F.col("blocks").cast("long") + F.greatest("block", "other")
    rows = dealt.join(nodes.select("node", "ints"), "node").select("key", cell.alias("cell"), (F.col("block") == F.col("other")).alias("within"), "block", "node", "component", "at", "ints")
    return storage.in_arrow(rows.repartition("key", "cell").sortWithinPartitions("key", "cell"), _meeting, "u long, v long, offset int, n long")


def align(recordings: DataFrame) -> DataFrame:
    """For ``recordings(id, payload)``: (id, n_ints, ints, group_id, aligned_with, offset, bit_error), a row each.

    ``aligned_with`` is the id that names the best aligned earlier fingerprint (its smallest id), ``offset`` how many
    integers later the common stretch begins there; null where there is none.
    """
    rows = recordings.select(F.col("id").cast("long").alias("id"), F.col("payload").cast("binary").alias("payload"))
    prints = storage.staged(storage.in_arrow(rows, _fingerprint, FINGERPRINTS), "fingerprints")
    surrogate = F.lit(NO_ID) + F.pmod(F.xxhash64("c1", "c2"), F.lit(NO_ID))
    classes = prints.groupBy("c1", "c2").agg(F.min("id").alias("least"), F.first("ints").alias("ints"))
    nodes = storage.staged(classes.select("c1", "c2", "least", F.coalesce("least", surrogate).alias("node"), "ints"), "recordings")
    twice = nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1").select("node")
    if not twice.isEmpty():  # one id, several recordings: each gets a number of its own
        alone = nodes.join(twice, "node", "left_anti").select(*nodes.columns)
        shared = nodes.join(twice, "node", "left_semi").select(*[surrogate.alias("node") if c == "node" else F.col(c) for c in nodes.columns])
        nodes = storage.staged(alone.unionByName(shared), "recordings")
    keys = storage.in_arrow(nodes.select("node", "ints"), _keys, "key long, node long, at int, before long")
    first = keys.groupBy("key").agg(F.min(F.struct("node", "at")).alias("first"), F.max("node").alias("last")).filter("first.node < last").select("key", F.col("first.node").alias("v"), F.col("first.at").alias("at_v"))
    shared = storage.staged(keys.join(first, "key"), "shared-keys")
    met = shared.filter("node <> v").groupBy(F.col("node").alias("u"), "v", (F.col("at_v") - F.col("at")).alias("offset")).agg(F.count("*").alias("n"))
    links = compared(met, nodes)
    parts = connected_components(links.select("u", "v"))
    more = compared(across(shared.select("key", "node", "at", "before"), nodes, parts), nodes)
    if not more.isEmpty():
        links = links.unionByName(more)
        parts = connected_components(links.select("u", "v"))
    nearest = links.groupBy(F.col("u").alias("node")).agg(F.min(F.struct("bit_error", "v", "offset")).alias("near"))
    own = nodes.select("c1", "c2", "node", "least").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = own.groupBy("component").agg(F.min("least").alias("group_id"))
    earlier = nodes.select(F.col("node").alias("near_node"), F.col("least").alias("aligned_with"))
    named = own.join(names, "component").join(nearest, "node", "left").withColumn("near_node", F.col("near.v")).join(earlier, "near_node", "left")
    named = named.select("c1", "c2", "group_id", "aligned_with", F.col("near.offset").alias("offset"), F.col("near.bit_error").alias("bit_error"))
    out = prints.join(named, ["c1", "c2"])
    return out.select("id", (F.octet_length("ints") / 4).cast("long").alias("n_ints"), "ints", "group_id", "aligned_with", "offset", "bit_error")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op9: the documents' bytes as recordings of 8-bit samples."""
    docs = storage.documents(spark, sf_dir).select(F.col("doc_id").alias("id"), F.encode("text", "UTF-8").alias("payload"))
    out = align(docs)
    return out.select(F.col("id").alias("doc_id"), "n_ints", F.crc32("ints").alias("ints_crc32"), "group_id", "aligned_with", F.col("offset").cast("long").alias("offset"), "bit_error")
