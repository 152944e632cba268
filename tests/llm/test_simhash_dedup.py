import random

import numpy as np
import pytest

from paperloom.llm import simhash_dedup, simhash, storage


def shingles(text):
    return set(simhash.shingle_hashes(text, 5).tolist())


def brute(rows, least=0.8):
    """Components of all pairs of the rows' texts; the smallest key of each."""
    sets = [shingles(t) for _, t in rows]
    words = [" ".join(x.decode() for x in (t or "").encode().lower().split()) for _, t in rows]
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            union = len(sets[a] | sets[b])
            if words[a] == words[b] or (union and both / union >= least):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return [top(i) for i in range(len(rows))]


def test_matches_all_pairs(spark):
    docs = storage.documents(spark, "/root/testdata/sf0.01")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    want = sorted({rows[i][0] for i in brute(rows)})
    assert sorted(r.doc_id for r in simhash_dedup.distinct_documents(docs).collect()) == want


def test_edited_copies(spark, frame):
    rng, rows = random.Random(2), []
    vocabulary = [f"w{i}" for i in range(2000)]
    for family in range(40):
        words = rng.choices(vocabulary, k=rng.choice([30, 80, 300, 1500]))
        for _ in range(6):
            own = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 100))):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
    got = sorted(r.doc_id for r in simhash_dedup.distinct_documents(frame(rows, "doc_id long, text string")).collect())
    want = sorted({rows[i][0] for i in brute(rows)})
    assert got == want


def test_odd_rows(spark, frame, odd_documents):
    rows = [(5, "A b"), (5, "a  B "), (5, "other text here"), (5, "other text here"), (None, "a b"), (None, "only without id"), (7, None), (8, " "), (9, "")]
    docs = frame(rows, "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS doc", "'x' AS number")
    out = simhash_dedup.distinct_documents(docs)
    assert out.columns == docs.columns
    got = sorted(((r.doc_id, (r.text or "").lower().split()) for r in out.collect()), key=str)
    assert got == sorted([(5, ["a", "b"]), (5, ["other", "text", "here"]), (None, ["only", "without", "id"]), (7, [])], key=str)
    assert simhash_dedup.distinct_documents(odd_documents).count() == len({tuple((r.text or "").encode().lower().split()) for r in odd_documents.collect()})
    assert simhash_dedup.distinct_documents(frame([], "doc_id long, text string")).count() == 0


def test_bags_of_like_sets_agree():
    rng = np.random.default_rng(4)
    missed = 0
    for _ in range(300):
        n = int(rng.integers(40, 400))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        change = max(1, n // 9)
        b = np.concatenate([a[change:], rng.integers(0, 1 << 63, change, dtype=np.uint64)])
        x, y = (set(zip(*(v.tolist() for v in simhash_dedup.bag_fingerprints(np.unique(s))))) for s in (a, b))
        missed += not x & y
    assert missed <= 1


def star(rng, length, variants, edits, spread):
    """An original in the middle of the ids, and variants that are near to it but not to each other."""
    base = [f"b{rng.randrange(10**6)}" for _ in range(length)]
    rows = []
    for i in range(variants):
        own = list(base)
        for place in rng.sample(range(0, length, spread), edits):
            own[place] = f"e{rng.randrange(10**9)}"
        rows.append((i if i < variants // 2 else i + 1, " ".join(own)))
    return [*rows, (variants // 2, " ".join(base))]



def test_original_in_the_middle(spark, frame):
    rows = star(random.Random(5), 400, 100, 6, 10)
    sets = {i: shingles(t) for i, t in rows}
    like = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert min(like(50, i) for i in sets) >= 0.8 and sum(like(a, b) < 0.8 for a in sets for b in sets if a < b) > 4000
    got = sorted(r.doc_id for r in simhash_dedup.distinct_documents(frame(rows, "doc_id long, text string")).collect())
    assert got == [0]


def test_repeats_within_a_copy(frame):
    words = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(words)), (2, " ".join([*words, *words[:6] * 300]))]
    sets = [shingles(t) for _, t in rows]
    assert len(sets[0] & sets[1]) / len(sets[0] | sets[1]) >= 0.8
    fps = [simhash.fingerprint(simhash.shingle_hashes(t, 5)) for _, t in rows]
    assert (fps[0] ^ fps[1]).bit_count() > 19
    got = [r.doc_id for r in simhash_dedup.distinct_documents(frame(rows, "doc_id long, text string")).collect()]
    assert got == [1]


@pytest.mark.parametrize("replaced", [4, 5])
def test_every_link_of_many_edits_is_found(frame, replaced):
    rng = random.Random(replaced)
    base = [f"w{rng.randrange(5000)}" for _ in range(300)]
    rows = []
    for i in range(400):
        own = list(base)
        for place in rng.sample(range(300), replaced):
            own[place] = f"e{rng.randrange(10**9)}"
        rows.append((i, " ".join(own)))
    sets = [shingles(t) for _, t in rows]
    groups = {r.doc_id: r.component for r in simhash_dedup.grouped(frame(rows, "doc_id long, text string")).collect()}
    links = [(a, b) for a in range(400) for b in range(a) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert links and all(groups[a] == groups[b] for a, b in links), sum(groups[a] != groups[b] for a, b in links)


@pytest.mark.parametrize("words", [6, 9, 14, 24, 60])
def test_short_texts_at_the_threshold(frame, words):
    """Bags hold all shingles of a small set, so that two sets at the threshold always share a bag."""
    rng, rows = random.Random(words), []
    for _ in range(150):
        base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
        rows.append((len(rows), " ".join(base)))
        rows.append((len(rows), " ".join([*base, *(f"t{rng.randrange(10**6)}" for _ in range(max(1, (words - 4) // 5)))])))
    sets = [shingles(t) for _, t in rows]
    like = [(a, a + 1) for a in range(0, len(rows), 2) if len(sets[a] & sets[a + 1]) >= 0.8 * len(sets[a] | sets[a + 1])]
    groups = {r.doc_id: r.component for r in simhash_dedup.grouped(frame(rows, "doc_id long, text string")).collect()}
    missed = [x for x in like if groups[x[0]] != groups[x[1]]]
    assert not missed, (len(missed), len(like))


def test_marks_never_overstate_a_difference():
    rng = np.random.default_rng(6)
    for _ in range(200):
        a = np.unique(rng.integers(0, 1 << 63, int(rng.integers(0, 3000)), dtype=np.uint64))
        b = np.unique(np.concatenate([a[: int(rng.integers(0, len(a) + 1))], rng.integers(0, 1 << 63, int(rng.integers(0, 60)), dtype=np.uint64)]))
        bits = sum(int(x).bit_count() for x in simhash_dedup.marks(a).view(np.uint64) ^ simhash_dedup.marks(b).view(np.uint64))
        assert bits <= len(np.setxor1d(a, b))


def test_recall_over_many_texts_and_lengths(frame):
    """1,200 texts of 6 to 1,500 words in 300 families whose members differ by replaced, added, left out and moved words."""
    rng, rows, families = random.Random(12), [], []
    for _ in range(300):
        n = int(6 * 250 ** rng.random())
        base = [f"w{rng.randrange(3000)}" for _ in range(n)]
        family = [base]
        for _ in range(3):
            own, many = list(base), rng.randint(1, max(1, n // 60))
            for _ in range(many):
                at = rng.randrange(len(own))
                kind = rng.randrange(4)
                if kind == 0:
                    own[at] = f"e{rng.randrange(10**9)}"
                elif kind == 1:
                    own[at:at] = [f"e{rng.randrange(10**9)}" for _ in range(rng.randint(1, 3))]
                elif kind == 2 and len(own) > 5:
                    del own[at]
                else:
                    own.append(own.pop(at))
            family.append(own)
        families.append([len(rows) + i for i in range(4)])
        rows += [(len(rows) + i, " ".join(w)) for i, w in enumerate(family)]
    sets = [shingles(t) for _, t in rows]
    links = [(a, b) for f in families for a in f for b in f if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    groups = {r.doc_id: r.component for r in simhash_dedup.grouped(frame(rows, "doc_id long, text string")).collect()}
    assert len(links) > 700 and sum(groups[a] == groups[b] for a, b in links) == len(links)
