import zlib

import numpy as np
import pyarrow as pa
import pytest

from paperloom.llm import toxicity


def tiny_model(seed=3):
    return toxicity._fresh(np.random.default_rng(seed))


def slow_pool(model, text):
    vectors = [model.embedding[list(toxicity.word_buckets(w))].sum(0) for w in (text or "").split()]
    out = []
    for width, f, bias in zip(toxicity.WIDTHS, model.filters, model.bias):
        best = None
        for i in range(len(vectors)):
            v = sum(vectors[i + j] @ f[j] for j in range(width) if i + j < len(vectors))
            best = v if best is None else np.maximum(best, v)
        out.append(np.zeros(toxicity.FILTERS) if best is None else np.maximum(best + bias, 0))
    return np.concatenate(out)


def test_pooling_matches_a_plain_loop(monkeypatch):
    model = tiny_model()
    texts = ["one", "", None, "a b c", "some words, some more words here", "x " * 500]
    for step in (toxicity.STEP, 3):
        monkeypatch.setattr(toxicity, "STEP", step)
        got = toxicity.pooled(model, *toxicity.split_words(pa.array(texts)))
        assert np.allclose(got, [slow_pool(model, t) for t in texts], atol=1e-4)


def test_gradients_match_differences():
    model = tiny_model()
    for name in ("embedding", "dense"):
        setattr(model, name, getattr(model, name).astype(np.float64))
    model.filters, model.bias = [f.astype(np.float64) for f in model.filters], [b.astype(np.float64) for b in model.bias]
    table, words, bounds = toxicity.split_words(pa.array(["a b c d", "e f", "g a b h i"]))
    wanted, weight = np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        total = 0
        for d, text in enumerate(["a b c d", "e f", "g a b h i"]):
            logit = slow_pool(model, text) @ model.dense + model.offset
            p = 1 / (1 + np.exp(-logit))
            total -= weight[d] * (np.log(p) if wanted[d] else np.log(1 - p)) / 3
        return total

    grads = toxicity._gradients(model, table, words, bounds, wanted, weight)
    for values, g in [(model.embedding, grads[0]), (model.filters[0], grads[1]), (model.filters[2], grads[3]), (model.bias[1], grads[5]), (model.dense, grads[7])]:
        flat = np.argsort(-np.abs(g), axis=None)[:5]
        for at in (np.unravel_index(i, g.shape) for i in flat):
            old = values[at]
            values[at] = old + 1e-5
            up = loss()
            values[at] = old - 1e-5
            down = loss()
            values[at] = old
            assert g[at] == pytest.approx((up - down) / 2e-5, rel=0.02, abs=1e-5)


@pytest.fixture
def corpus(frame):
    rng = np.random.default_rng(0)
    calm = [f"calm{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(1200):
        words = list(rng.choice(calm, rng.integers(5, 60)))
        toxic = int(rng.random() < 0.2)
        if toxic:
            words[rng.integers(len(words))] = rng.choice(["vilest", "vilenes", "rotten!"])
        rows.append((i, " ".join(words), ["en", "fr", None][i % 3]))
        labels.append((i, 1, toxic if i % 50 else None))
    return frame(rows, "doc_id long, text string, lang string"), frame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels)
    got = toxicity.score(docs.selectExpr("*", "9 AS toxic"), model).join(labels.withColumnRenamed("toxic", "wanted"), "doc_id").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2 and r.wanted is not None]
    right = np.mean([(r.toxicity >= 0.3) == bool(r.wanted) for r in held])
    assert len(held) > 200 and right > 0.97
    assert np.mean([r.toxic == bool(r.wanted) for r in held]) > 0.95


def test_labels_of_the_held_out_fold_do_not_matter(corpus):
    from pyspark.sql import functions as F

    docs, labels = corpus
    changed = labels.withColumn("toxic", F.when(toxicity.fold() == 2, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, changed)
    assert np.array_equal(a.embedding, b.embedding) and a.scale == b.scale


def test_sample_is_bounded_in_words(corpus, monkeypatch):
    docs, labels = corpus
    monkeypatch.setattr(toxicity, "SAMPLE_WORDS", 12_000)
    seen = []
    monkeypatch.setattr(toxicity, "_trained", lambda share, batches: iter([pa.RecordBatch.from_pydict({"model": pa.array([str(sum(r["n_words"] for b in batches for r in b.to_pylist())).encode()], pa.binary())})]))
    monkeypatch.setattr(toxicity.pickle, "loads", lambda data: seen.append(int(data)))
    toxicity.fit(docs, labels)
    assert 11_000 < seen[0] <= 12_000


def test_columns_of_the_outputs_names_stay(corpus):
    docs, labels = corpus
    model = toxicity.fit(docs, labels)
    clash = docs.selectExpr("*", "'mine' AS toxicity", "7 AS toxic", "'x' AS own")
    out = toxicity.without_toxic(clash, model)
    assert out.columns == clash.columns and 0 < out.count() < docs.count()
    assert {(r.toxicity, r.toxic, r.own) for r in out.select("toxicity", "toxic", "own").distinct().collect()} == {("mine", 7, "x")}


def test_odd_rows(odd_documents, frame):
    none = frame([], "doc_id long, quality int, toxic int")
    model = toxicity.fit(odd_documents, none)
    assert {r.toxicity for r in toxicity.score(odd_documents, model).collect()} == {0.0}
    trained = tiny_model()
    out = toxicity.score(odd_documents, trained)
    assert out.count() == odd_documents.count() and all(0 <= r.toxicity <= 1 for r in out.collect())
    dotted = toxicity.score(odd_documents.selectExpr("*", "1 AS `a.b`", "2 AS own"), trained)
    assert {(r["a.b"], r.own) for r in dotted.collect()} == {(1, 2)} and dotted.columns[-2:] == ["toxicity", "toxic"]
    assert toxicity.score(odd_documents.limit(0), trained).count() == 0
    all_toxic = frame([(i, 0, 1) for i in range(9)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(odd_documents, all_toxic).constant == 1.0


def test_rows_beyond_the_start_are_learnt_from(spark, frame, monkeypatch):
    rng = np.random.default_rng(1)
    calm = [f"calm{i}" for i in range(300)]
    ids = [r.id for r in spark.range(3000).selectExpr("id", "xxhash64(id) AS h").orderBy("h").collect()]
    rows, labels = [], []
    for place, i in enumerate(ids):
        words = list(rng.choice(calm, rng.integers(5, 60)))
        toxic = int(rng.random() < 0.3)
        if toxic:  # the word of most toxic rows is in none of smallest hash
            words[rng.integers(len(words))] = "vilest" if place < 900 else "grimmest"
        rows.append((i, " ".join(words), "en"))
        labels.append((i, 1, toxic))
    docs, labelled = frame(rows, "doc_id long, text string, lang string"), frame(labels, "doc_id long, quality int, toxic int")
    monkeypatch.setattr(toxicity, "SAMPLE_POSITIVE", 150)
    monkeypatch.setattr(toxicity, "SAMPLE_NEGATIVE", 300)
    model = toxicity.fit(docs.repartition(3), labelled)
    got = toxicity.score(docs, model).filter(toxicity.fold() == 2).collect()
    found = {word: np.mean([r.toxicity >= 0.3 for r in got if word in r.text.split()]) for word in ("vilest", "grimmest")}
    assert found["grimmest"] > 0.95 and found["vilest"] > 0.95, found
    assert np.mean([r.toxicity >= 0.3 for r in got if not {"vilest", "grimmest"} & set(r.text.split())]) < 0.05
    assert set(model.thresholds) == {"en"}


def test_gradients_of_long_texts_are_the_same_in_pieces(monkeypatch):
    model = tiny_model()
    table, words, bounds = toxicity.split_words(pa.array(["a b c d e f g h", "e f", "g a b h i k l m n"]))
    wanted, weight = np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])
    whole = toxicity._gradients(model, table, words, bounds, wanted, weight)
    monkeypatch.setattr(toxicity, "STEP", 3)
    assert all(np.allclose(a, b, atol=1e-6) for a, b in zip(whole, toxicity._gradients(model, table, words, bounds, wanted, weight)))
