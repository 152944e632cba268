import random

import corpus_pipeline
from paperloom.llm import simhash


def _near(rnd):
    """Two texts whose whole fingerprints differ in at most the radius, and whose five-word shingles are less alike than 0.8."""
    words = [f"w{i}" for i in range(rnd.randint(4, 40))]
    base = "same words here " * 40
    a, b = base + " ".join(words[:1]), base + " ".join(words)
    return a, b


def test_whole_fingerprints_tie_documents(spark, frame):
    rnd, rows = random.Random(5), []
    for i in range(12):
        a, b = _near(rnd)
        rows += [(10 * i, f"{a} {i}", "en", "s", len(a)), (10 * i + 1, f"{b} {i}", "en", "s", len(b))]
    rows += [(1000 + i, " ".join(rnd.choice("abcdefghijklmnop") * 3 + str(rnd.randrange(500)) for _ in range(60)), "en", "s", 1) for i in range(20)]
    docs = frame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    sets = {d: set(simhash.shingle_hashes(t, 5).tolist()) for d, t, *_ in rows}
    apart = [(10 * i, 10 * i + 1) for i in range(12) if len(sets[10 * i] & sets[10 * i + 1]) < 0.8 * len(sets[10 * i] | sets[10 * i + 1])]
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert any(found[a] == found[b] for a, b in apart)  # what shingles alone don't tie
    kept = {r.doc_id for r in corpus_pipeline.drop_copies(spark, docs, "").collect()}
    for component in set(found.values()):
        assert len(kept & {d for d, c in found.items() if c == component}) <= 1
    assert len(kept & set(range(1000, 1020))) == 20
