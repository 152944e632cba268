import numpy as np

from paperloom.llm import media


def test_recordings_whose_keys_all_have_other_first_holders_are_grouped(spark):
    rng = np.random.default_rng(4)
    noise = lambda n: rng.integers(0, 256, n, dtype=np.uint8).tobytes()
    whole = noise(8192)
    # four earlier recordings hold a piece each of what the last two share, and align with neither
    rows = [(i, bytearray(noise(64 * 140) + whole[a : a + 2944] + noise(64 * 140))) for i, a in enumerate((0, 1792, 3584, 5376), 1)]
    rows += [(10, bytearray(whole)), (11, bytearray(whole + noise(640))), (12, bytearray(noise(8192)))]
    found = {r.id: r for r in media.align(spark.createDataFrame(rows, "id long, payload binary")).collect()}
    ints = {i: np.frombuffer(r.ints, "<u4") for i, r in found.items()}
    keys = lambda i: set(zip(ints[i][:-1].tolist(), ints[i][1:].tolist()))
    assert keys(10) & keys(11) <= keys(1) | keys(2) | keys(3) | keys(4)
    assert {i: found[i].group_id for i in found} == {1: 1, 2: 2, 3: 3, 4: 4, 10: 10, 11: 10, 12: 12}
    assert (found[11].aligned_with, found[11].offset) == (10, 0)


def test_recordings_that_share_a_passage_only_are_ruled_out_where_they_meet(spark, monkeypatch):
    rng = np.random.default_rng(5)
    noise = lambda n: rng.integers(0, 256, n, dtype=np.uint8).tobytes()
    passage = noise(1600)
    rows = [(i, bytearray(noise(64 * 30) + passage + noise(64 * 30))) for i in range(40)]
    rows += [(100 + i, bytearray(bytes(rows[i][1]) + noise(64 * 4))) for i in (3, 7)]
    met, compared = [], media.compared
    monkeypatch.setattr(media, "HOLDERS", 8)  # a key's holders are dealt over several tasks
    monkeypatch.setattr(media, "compared", lambda pairs, nodes: met.append(pairs.select("u", "v").distinct().count()) or compared(pairs, nodes))
    groups = {r.id: r.group_id for r in media.align(spark.createDataFrame(rows, "id long, payload binary")).collect()}
    assert groups == {i: i for i in range(40)} | {103: 3, 107: 7}
    assert met[1] < len(rows)  # all pairs of the passage's holders: 861


def test_long_recordings_that_share_a_passage_only_are_ruled_out_where_they_meet(spark, monkeypatch):
    rng = np.random.default_rng(6)
    noise = lambda n: rng.integers(0, 256, n, dtype=np.uint8).tobytes()
    passage = noise(1600)
    rows = [(i, bytearray(noise(64 * 300) + passage + noise(64 * 300))) for i in range(24)]
    rows += [(100, bytearray(bytes(rows[5][1]) + noise(64 * 4)))]
    met, compared = [], media.compared
    monkeypatch.setattr(media, "HOLDERS", 8)  # a key's holders meet in cells of two blocks
    monkeypatch.setattr(media, "compared", lambda pairs, nodes: met.append(pairs.select("u", "v").distinct().count()) or compared(pairs, nodes))
    groups = {r.id: r.group_id for r in media.align(spark.createDataFrame(rows, "id long, payload binary")).collect()}
    assert groups == {i: i for i in range(24)} | {100: 5}
    assert met[1] == 0 or met[1] == 1  # but the copy's couple, if its keys have an earlier first holder


def test_couples_across_groups_are_those_of_all_pairs(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(7)
    base = [rng.integers(0, 1 << 32, 30, dtype=np.uint32) for _ in range(4)]
    ints = []
    for k in range(24):
        x = base[k % 4][int(rng.integers(0, 8)) :].copy()
        noisy = rng.random(len(x)) < 0.5 * (k % 3) / 2
        x[noisy] = rng.integers(0, 1 << 32, int(noisy.sum()), dtype=np.uint32)
        ints.append(x)
    kept = [r for b in media._keys([pa.RecordBatch.from_arrays([pa.array(range(24), pa.int64()), pa.array([x.tobytes() for x in ints], pa.binary())], names=["node", "ints"])]) for r in b.to_pylist()]
    holders = {}
    for r in kept:
        holders.setdefault(r["key"], []).append(r)
    want = set()
    for rows in holders.values():
        for a in rows:
            for b in rows:
                error, common = media.bit_error(ints[a["node"]], ints[b["node"]], b["at"] - a["at"])
                if a["node"] > b["node"] and error <= media.BIT_ERRORS and common >= max(media.LEAST_COMMON, media.COVER * min(len(ints[a["node"]]), len(ints[b["node"]]))):
                    want.add((a["node"], b["node"], b["at"] - a["at"]))
    assert want
    whole = {k: v for k, v in holders.items() if min(r["before"] for r in v) < 0 or len({r["before"] for r in v}) > 1}
    assert len(whole) < len(holders)  # keys after a shared one are left out
    cells = [dict(key=k, cell=0, within=True, block=0, node=r["node"], component=r["node"], at=r["at"], ints=ints[r["node"]].tobytes()) for k in sorted(whole) for r in whole[k]]
    schema = pa.schema([("key", pa.int64()), ("cell", pa.int64()), ("within", pa.bool_()), ("block", pa.int32()), ("node", pa.int64()), ("component", pa.int64()), ("at", pa.int32()), ("ints", pa.binary())])
    monkeypatch.setattr(media, "COUPLES", 50)
    monkeypatch.setattr(media, "COMPARED", 300)
    found = [r for b in media._meeting(pa.RecordBatch.from_pylist(cells[i : i + 7], schema) for i in range(0, len(cells), 7)) for r in b.to_pylist()]
    assert {(r["u"], r["v"], r["offset"]) for r in found} == want
    for r in found:
        a, b = ints[r["u"]], ints[r["v"]]
        same = [0 <= i + r["offset"] < len(b) and a[i] == b[i + r["offset"]] for i in range(len(a))]
        assert r["n"] == sum(p and q for p, q in zip(same, same[1:]))
