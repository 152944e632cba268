import random

import xxhash

from paperloom.llm import components, simhash, storage


def brute_fp(text, size=3):
    words = [w for w in bytes(text or "", "utf-8").lower().split()]
    runs = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))] if words else []
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(pairs, nodes):
    parent = {n: n for n in nodes}

    def top(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in storage.documents(spark, sf).collect()]
    fps = {d: brute_fp(t) for d, t in rows}
    near = [(a, b) for a in fps for b in fps if a < b and bin(fps[a] ^ fps[b]).count("1") <= 2]
    want = closure(near, fps)
    got = simhash.query(spark, sf).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted((d, f"{fps[d]:016x}", want[d]) for d in fps)


def test_links_connect_as_all_pairs_do(spark, frame):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(30)]
    fps = set(base)
    for b in base:  # chains of near fingerprints
        x = b
        for _ in range(6):
            x ^= (1 << rng.randrange(64)) | (1 << rng.randrange(64))
            fps.add(x)
    crowd = rng.getrandbits(64)  # many under the same keys
    fps |= {crowd ^ (1 << a) ^ (1 << b) for a in range(0, 22) for b in range(a, 22)}
    fps = sorted(fps)
    nodes = frame([(i, simhash._signed(f)) for i, f in enumerate(fps)], "node long, fp long")
    near = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 2]
    want = closure(near, range(len(fps)))
    for paired in (4, 10_000):
        links = [(r.u, r.v) for r in simhash.links(nodes, paired).collect()]
        assert all(bin(fps[u] ^ fps[v]).count("1") <= 2 for u, v in links)
        assert closure(links, range(len(fps))) == want
        if paired > len(fps):
            assert set(links) == set(near)


def test_chain_keys():
    keys = simhash.chain_keys()
    assert len(keys) == 15 and {bin(k).count("1") for k in keys} <= {42, 43, 44}


def test_odd_rows(spark, odd_documents, frame):
    got = {(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(odd_documents).collect()}
    fps = {}
    for r in odd_documents.collect():
        fps.setdefault(brute_fp(r.text), set()).add(r.doc_id)
    want = {(d, f, min([x for x in ids if x is not None], default=None)) for f, ids in fps.items() for d in ids}
    assert got == want
    assert simhash.near_duplicates(frame([], "doc_id long, text string, fp int")).count() == 0


def test_components(spark, frame):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(0, 60)] + [(100, 150 + i) for i in range(50)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(7, 7)]
    got = {r.node: r.component for r in components.connected_components(frame(pairs, "u long, v long")).collect()}
    want = closure(pairs, {x for p in pairs for x in p})
    assert got == {n: c for n, c in want.items() if n in got} and all(want[n] == n for n in want if n not in got)
    assert components.connected_components(frame([], "u long, v long")).count() == 0


def test_any_number_may_be_an_id(frame):
    big = (1 << 63) - 5
    rows = [(big, "one two three four"), (big - 9, "one two three four"), (None, "alone without id"), (-(1 << 63), "something else entirely here"), (1 << 62, "yet another text of words")]
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(frame(rows, "doc_id long, text string")).collect()}
    assert got == {(big, big - 9), (big - 9, big - 9), (None, None), (-(1 << 63), -(1 << 63)), (1 << 62, 1 << 62)}
