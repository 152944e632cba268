import io
import wave

import numpy as np

from paperloom.llm import media, storage


def tone(seconds, seed, rate=media.RATE):
    """A tune of random notes as 8-bit samples."""
    rng, out = np.random.default_rng(seed), []
    for _ in range(int(seconds * 8)):
        f = 220 * 2 ** (rng.integers(0, 36) / 12)
        t = np.arange(rate // 8) / rate
        out.append(np.sin(2 * np.pi * f * t) * 0.6 + np.sin(4 * np.pi * f * t) * 0.2)
    x = np.concatenate(out)
    return np.clip(128 + 120 * x + rng.normal(0, 1, len(x)), 0, 255).astype(np.uint8).tobytes()


def plain_fingerprint(data):
    """The same integers by sums over the frames, one window after the other."""
    x, classes = media.samples(data), media.pitch_classes()
    frames = [x[i : i + media.FRAME] for i in range(0, len(x) - media.FRAME + 1, media.HOP)]
    chroma = []
    for f in frames:
        power = np.abs(np.fft.rfft((f - f.mean()) * np.hanning(media.FRAME).astype(np.float32))) ** 2
        c = power @ classes
        chroma.append(c / max(c.sum(), 1e-9))
    out = []
    for i in range(len(chroma) - media.WINDOW + 1):
        w, code = np.array(chroma[i : i + media.WINDOW], np.float64), 0
        for plus, minus in media.filter_bank():
            mean = lambda areas: sum(w[a:b, c:d].sum() for a, b, c, d in areas) / sum((b - a) * (d - c) for a, b, c, d in areas)
            v = np.log1p(12 * mean(plus)) - np.log1p(12 * mean(minus))
            code = code << 2 | [0, 1, 3, 2][int(np.searchsorted(media.LEVELS, round(float(v), 6), "right"))]
        out.append(code)
    return np.array(out, np.uint32)


def test_integral_image_matches_plain_sums():
    songs = [tone(1, 1), b"", b"abc", tone(0.5, 2), bytes(3000)]
    ints, bounds = media.fingerprints([media.samples(s) for s in songs])
    for s, a, b in zip(songs, bounds, bounds[1:]):
        want = plain_fingerprint(s)
        assert b - a == len(want)
        if len(want):
            assert np.mean(np.bitwise_count(ints[a:b] ^ want)) < 0.2  # rounding at the levels


def test_filters_lie_in_the_window():
    bank = media.filter_bank()
    assert len(bank) == 16 and len({str(x) for x in bank}) == 16
    for areas in (x for pair in bank for x in pair):
        assert all(0 <= a < b <= media.WINDOW and 0 <= c < d <= 12 for a, b, c, d in areas)


def wav(data):
    out = io.BytesIO()
    with wave.open(out, "wb") as f:
        f.setnchannels(1), f.setsampwidth(1), f.setframerate(media.RATE), f.writeframes(data)
    return out.getvalue()


def test_alignment(spark, frame):
    a, b = tone(6, 5), tone(6, 6)
    noise = np.random.default_rng(3)
    noisy = np.clip(np.frombuffer(a, np.uint8).astype(int) + noise.integers(-3, 4, len(a)), 0, 255).astype(np.uint8).tobytes()
    rows = [(1, a), (2, a), (3, wav(a)), (4, a[64 * 40 :]), (5, noisy), (6, b), (7, b[: 64 * 200]), (8, tone(6, 9)), (9, None), (10, b""), (11, b"RIFFxxxxWAVEbroken"), (None, a), (6, tone(4, 77))]
    docs = frame(rows, "id long, payload binary").selectExpr("*", "1 AS offset", "2 AS c1")
    got = media.align(docs).collect()
    assert len(got) == len(rows)
    group = {}
    for r in got:
        group.setdefault(r.id, []).append(r.group_id)
    assert group[1] == group[2] == group[3] == group[4] == group[5] == group[None] == [1]
    assert group[6] == [6, 6] and group[7] == [6] and group[8] == [8]
    four = next(r for r in got if r.id == 4)
    assert (four.aligned_with, four.offset) == (1, 40) and four.bit_error < 0.05
    assert next(r for r in got if r.id == 9).n_ints == 0 and group[9] == group[10] == [9] and group[11] == [11]


def test_groups_match_all_pairs(spark, frame):
    rng, rows = np.random.default_rng(8), []
    for i in range(12):
        song = np.frombuffer(tone(3, 100 + i), np.uint8).astype(int)
        for k in range(4):
            cut = song[64 * rng.integers(0, 60) :]
            rows.append((len(rows), np.clip(cut + rng.integers(-2, 3, len(cut)), 0, 255).astype(np.uint8).tobytes()))
    prints = [plain_fingerprint(p) for _, p in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for u in range(len(rows)):
        for v in range(u):
            for offset in range(-70, 71):
                error, common = media.bit_error(prints[u], prints[v], offset)
                if common >= 60 and error <= 0.1:
                    a, b = sorted((top(u), top(v)))
                    parent[b] = a
    got = {r.id: r.group_id for r in media.align(frame(rows, "id long, payload binary")).collect()}
    assert got == {i: top(i) for i in range(len(rows))}


def test_empty_table(frame):
    assert media.align(frame([], "id long, payload binary")).count() == 0


def test_query_finds_the_links_of_all_pairs(spark):
    """Recall at the module's own thresholds, against every pair and every offset at which two neighbouring integers agree."""
    sf = "/root/testdata/sf0.001"
    rows = {r.doc_id: (r.text or "").encode() for r in storage.documents(spark, sf).collect()}
    groups = {r.doc_id: r.group_id for r in media.query(spark, sf).collect()}
    assert set(groups) == set(rows)
    ints, bounds = media.fingerprints([media.samples(rows[i]) for i in rows])
    own = {i: ints[a:b] for i, a, b in zip(rows, bounds, bounds[1:])}
    keys = {i: {} for i in own}
    for i, x in own.items():
        for at, key in enumerate(zip(x[:-1].tolist(), x[1:].tolist())):
            keys[i].setdefault(key, []).append(at)
    links = found = 0
    ids = sorted(own)
    for a, u in enumerate(ids):
        for v in ids[:a]:
            shared = keys[u].keys() & keys[v].keys()
            offsets = {j - i for k in shared for i in keys[u][k] for j in keys[v][k]}
            for offset in offsets:
                error, common = media.bit_error(own[u], own[v], offset)
                if error <= media.BIT_ERRORS and common >= max(media.LEAST_COMMON, media.COVER * min(len(own[u]), len(own[v]))):
                    links, found = links + 1, found + (groups[u] == groups[v])
                    break
    assert found >= 0.9 * links, (found, links)
