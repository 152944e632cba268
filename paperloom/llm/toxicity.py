"""Toxicity by a convolutional text classifier, written in numpy.

A word's vector is the sum of hashed embeddings of the word (lower-cased, without marks at its ends) and of its first
four and five letters. Filters of widths one, two and three run over the word vectors; each filter's maximum over the
text, after a rectifier, goes to a logistic layer. The classifier learns from all labelled rows of the training folds.
Tasks turn their texts into numbers of buckets. Up to ``SAMPLE_POSITIVE`` and ``SAMPLE_NEGATIVE`` rows and
``SAMPLE_WORDS`` words one task trains it, with Adam. Beyond that this task makes but the start, from the rows of
smallest hash: ``ROUNDS`` passes over all rows follow, in which every task goes on from the common model with its own
rows, and the tasks' models are averaged, a bucket's vector by the texts that hold the bucket. A held-back fifth (of all
labelled rows, none of them learnt from) scales the scores to probabilities at the labels' own share, and sets a
threshold per language. The driver gets nothing but models and counts of fixed sizes. Scoring runs over batches of whole
texts; the language is used to choose a threshold only.

Nulls and odd rows: a null text is an empty one, scored by the maximum over nothing (zero). Rows without label, of
null id or of the held-out fold are never learnt from. Without two classes to learn, every score is the share of toxic
labels (0 without labels). Texts of over a tenth of ``SAMPLE_WORDS`` words take part in the passes over all rows only. An
empty table gives no rows. Extra columns pass through; ``score`` replaces columns of its output's names, ``without_toxic``
keeps them.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from . import storage
from .tokenization import slices

BUCKETS = 1 << 15
DIMENSIONS = 12
FILTERS = 16
WIDTHS = (1, 2, 3)
SAMPLE_POSITIVE = 3000
SAMPLE_NEGATIVE = 5000
#: Words that one task trains on as a whole; rows of smallest hash come first.
SAMPLE_WORDS = 8_000_000
#: Passes over the sample, and steps of BATCH texts that are made at least (in at most MOST_EPOCHS passes).
EPOCHS = 6
LEAST_STEPS = 1500
MOST_EPOCHS = 25
BATCH = 32
RATE = 0.004
#: Passes over all rows after the start, and their rate, which falls to a ROUNDS-th.
ROUNDS = 3
ROUND_RATE = 0.002
#: One of so many rows is held back from the passes over all rows.
BACK = 5
#: Buckets of a row of vectors or counts on their way between tasks.
SLAB = 512
#: Logits are counted in steps of one by this.
LOGIT_STEPS = 128
SEED = 7
THRESHOLD = 0.3
#: Sampled texts that must hold a bucket's words for it to get a vector; rarer ones could only be learnt by heart.
LEAST_TEXTS = 6
#: Share of the words that a training step leaves out.
WORDS_OUT = 0.5
#: Languages with fewer held-back toxic rows use the threshold of all languages.
LEAST_PER_LANGUAGE = 20
MARKS = ".,;:!?\"'()[]{}<>|*&%$#@-_=+/\\«»„“”‘’…–—"
#: Words scored at once.
STEP = 100_000


def word_buckets(word: str) -> tuple[int, int, int]:
    """Buckets of the word and of its beginnings; bucket 0 is empty."""
    w = word.strip(MARKS).lower()
    if not w:
        return 0, 0, 0
    return tuple(1 + zlib.crc32(x.encode()) % (BUCKETS - 1) for x in (w, "4" + w[:4], "5" + w[:5]))


@dataclass
class Model:
    embedding: np.ndarray
    filters: list[np.ndarray]  # per width: (width, DIMENSIONS, FILTERS)
    bias: list[np.ndarray]
    dense: np.ndarray
    offset: float
    scale: tuple[float, float] = (1.0, 0.0)
    constant: float | None = None
    thresholds: dict[str, float] = field(default_factory=dict)
    threshold: float = THRESHOLD

    def score(self, pooled: np.ndarray) -> np.ndarray:
        """Probabilities from pooled filter values."""
        if self.constant is not None:
            return np.full(len(pooled), self.constant)
        logit = pooled.astype(np.float64) @ self.dense + self.offset
        return 1 / (1 + np.exp(-np.clip(self.scale[0] * logit + self.scale[1], -50, 50)))


def split_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of the distinct words, the index of each word, bounds of the texts)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(texts)
    bounds = split.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    coded = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
    words = coded.dictionary.to_pylist()
    table = np.array([word_buckets(w) for w in words], np.int64).reshape(-1, 3)
    return table, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), bounds - bounds[0]


def pooled(model: Model, table: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Each text's maximum of every filter, zero at least; the texts as ``split_words`` gives them."""
    vectors = model.embedding[table].sum(1)
    columns = [vectors @ f[j] for f in model.filters for j in range(len(f))]
    out = np.zeros((len(bounds) - 1, FILTERS * len(WIDTHS)), np.float32)
    a = 0
    while a < len(out):
        b = max(a + 1, int(np.searchsorted(bounds, bounds[a] + STEP, "right")) - 1)
        own, starts = words[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
        at = 0
        for w, (width, bias) in enumerate(zip(WIDTHS, model.bias)):
            total = columns[at][own]
            # a window beyond its text's end lacks the later words
            last = np.repeat(starts[1:], np.diff(starts))
            for j in range(1, width):
                inside = np.flatnonzero(np.arange(len(own)) + j < last)
                total[inside] += columns[at + j][own[inside + j]]
            at += width
            full = np.flatnonzero(np.diff(starts) > 0)
            if len(full):
                out[a + full, w * FILTERS : (w + 1) * FILTERS] = np.maximum(np.maximum.reduceat(total, starts[:-1][full], axis=0) + bias, 0)
        a = b
    return out


def _gradients(model: Model, table: np.ndarray, words: np.ndarray, starts: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Gradients of the weighted logistic loss: of embedding, filters, biases, dense weights and offset. Texts have a
    word each at least.

    The texts lie apart by as many zero columns as a filter reaches ahead, so that windows are plain shifts.
    """
    gap, docs, sizes = max(WIDTHS) - 1, len(wanted), np.diff(starts)
    n = len(words) + gap * docs
    buckets = np.zeros((n + gap, table.shape[1]), np.int64)
    buckets[np.arange(len(words)) + gap * np.repeat(np.arange(docs), sizes)] = table[words]
    x = sum(model.embedding[buckets[:, k]] for k in range(buckets.shape[1]))
    weights = np.concatenate([f[j] for f in model.filters for j in range(len(f))], 1).T
    best, top = np.zeros((docs, FILTERS * len(WIDTHS)), np.int64), np.full((docs, FILTERS * len(WIDTHS)), -np.inf, x.dtype)
    begins = starts[:-1] + gap * np.arange(docs)
    ends = begins + sizes
    for low in range(0, n, STEP):  # the values of long texts never stand in memory as a whole
        high = min(low + STEP, n)
        parts = weights @ np.ascontiguousarray(x[low : high + gap].T)
        total, at = np.empty((FILTERS * len(WIDTHS), high - low), x.dtype), 0
        for w, width in enumerate(WIDTHS):
            own = total[w * FILTERS : (w + 1) * FILTERS]
            own[:] = parts[at : at + FILTERS, : high - low]
            for j in range(1, width):
                own += parts[at + j * FILTERS : at + (j + 1) * FILTERS, j : j + high - low]
            at += width * FILTERS
        for d in range(int(np.searchsorted(ends, low, "right")), int(np.searchsorted(begins, high))):
            a, b = max(begins[d], low), min(ends[d], high)
            found = total[:, a - low : b - low].argmax(1)
            value = total[np.arange(len(total)), a - low + found]
            more = value > top[d]
            best[d, more], top[d, more] = (a + found)[more], value[more]
    pool = np.maximum(top + np.concatenate(model.bias), 0)
    logit = pool @ model.dense + model.offset
    error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - wanted) * weight / docs
    g_dense, g_offset = pool.T @ error, np.array(error.sum())
    g_pool = (np.outer(error, model.dense) * (pool > 0)).astype(x.dtype)
    g_filters, g_bias, places, amounts = [], [], [], []
    for w, (width, f) in enumerate(zip(WIDTHS, model.filters)):
        d, c = np.nonzero(g_pool[:, w * FILTERS : (w + 1) * FILTERS])
        c_all = c + w * FILTERS
        first, g_f = best[d, c_all], np.zeros_like(f)
        by_filter = np.zeros((len(d), FILTERS), x.dtype)
        by_filter[np.arange(len(d)), c] = g_pool[d, c_all]
        for j in range(width):
            g_f[j] = x[first + j].T @ by_filter
            places.append(buckets[first + j])
            amounts.append(by_filter @ f[j].T)
        g_filters.append(g_f)
        g_bias.append(g_pool[:, w * FILTERS : (w + 1) * FILTERS].sum(0))
    places, amounts = np.concatenate(places), np.concatenate(amounts)
    flat = (places[:, :, None] * DIMENSIONS + np.arange(DIMENSIONS)).ravel()
    g_embedding = np.bincount(flat, np.repeat(amounts[:, None], places.shape[1], axis=1).ravel(), model.embedding.size).reshape(model.embedding.shape)
    g_embedding[0] = 0
    return [g_embedding, *g_filters, *g_bias, g_dense, g_offset]


def rare_buckets(table: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Buckets of fewer than LEAST_TEXTS texts."""
    return np.flatnonzero(_texts_of_buckets(table, words, bounds) < LEAST_TEXTS)


class Adam:
    """Adam's steps on a model's parameters, in place."""

    def __init__(self, model: Model):
        params = self._parameters(model)
        self.means, self.squares = [np.zeros_like(p, dtype=np.float32) for p in params], [np.zeros_like(p, dtype=np.float32) for p in params]
        self.steps = 0

    @staticmethod
    def _parameters(model: Model) -> list[np.ndarray]:
        return [model.embedding, *model.filters, *model.bias, model.dense, np.array(model.offset)]

    def step(self, model: Model, grads: list[np.ndarray], rate: float) -> None:
        params = self._parameters(model)
        self.steps += 1
        rate = np.float32(rate * np.sqrt(1 - 0.999**self.steps) / (1 - 0.9**self.steps))
        for p, g, m, v in zip(params, grads, self.means, self.squares):
            g = g.astype(np.float32)
            m += np.float32(0.1) * (g - m)
            v += np.float32(0.001) * (g * g - v)
            p -= rate * m / (np.sqrt(v) + np.float32(1e-8))
        model.offset = float(params[-1])


def _step(model: Model, adam: Adam, rng: np.random.Generator, table: np.ndarray, words: np.ndarray, bounds: np.ndarray, docs: np.ndarray, wanted: np.ndarray, weight: np.ndarray, rate: float) -> None:
    """One step on these of the texts, with a share of their words left out."""
    parts = [words[bounds[d] : bounds[d + 1]] for d in docs]
    parts = [p[k] if (k := rng.random(len(p)) >= WORDS_OUT).any() else p for p in parts]
    starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
    adam.step(model, _gradients(model, table, np.concatenate(parts), starts, wanted[docs], weight[docs]), rate)


def _fresh(rng: np.random.Generator) -> Model:
    embedding = rng.normal(0, 0.15, (BUCKETS, DIMENSIONS)).astype(np.float32)
    embedding[0] = 0
    filters = [rng.normal(0, 0.3, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
    return Model(embedding, filters, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], rng.normal(0, 0.3, FILTERS * len(WIDTHS)).astype(np.float32), 0.0)


def _logistic(logits: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift that fit probabilities to logits, lightly held to (1, 0)."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -30, 30)))
        r, h = weight * (p - wanted), weight * p * (1 - p) + 1e-9
        g = np.array([(r * logits).sum() + (a - 1), r.sum() + b * 0.1])
        m = np.array([[(h * logits * logits).sum() + 1, (h * logits).sum()], [(h * logits).sum(), h.sum() + 0.1]])
        step = np.linalg.solve(m, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-6:
            break
    return max(float(a), 0.05), float(b)


def best_threshold(scores: np.ndarray, wanted: np.ndarray, weight: np.ndarray) -> float:
    """The threshold from THRESHOLD to 0.9 of best F-measure, precision counting double; the lowest of equals.

    With a measure under one half the scores tell too little, and THRESHOLD stays.
    """
    best, at = 0.5, THRESHOLD
    for t in np.linspace(THRESHOLD, 0.9, 61):
        hit = scores >= t
        good = (weight * (hit & (wanted == 1))).sum()
        measure = 1.25 * good / max((weight * hit).sum() + 0.25 * (weight * (wanted == 1)).sum(), 1e-9)
        if measure > best + 1e-12:
            best, at = measure, float(t)
    return at


def train(table: np.ndarray, words: np.ndarray, bounds: np.ndarray, wanted: np.ndarray, langs: list, share: float) -> Model:
    """Trains on texts in the form of ``split_words``; ``share`` is the share of toxic rows among all labelled ones."""
    rng = np.random.default_rng(SEED)
    model = _fresh(rng)
    usable = np.flatnonzero(np.diff(bounds))
    if not len(usable) or wanted[usable].min() == wanted[usable].max():
        model.constant = float(share)
        return model
    order = rng.permutation(usable)
    back, fit = order[: len(order) // 5], order[len(order) // 5 :]
    if len(back) < 50 or wanted[back].min() == wanted[back].max():
        back, fit = order, order
    # only buckets that are learnt take part in the steps
    live = np.setdiff1d(np.arange(1, BUCKETS), rare_buckets(table, words, bounds))
    number = np.zeros(BUCKETS, np.int64)
    number[live] = 1 + np.arange(len(live))
    whole, model.embedding, table = table, np.concatenate([model.embedding[:1], model.embedding[live]]), number[table]
    have = float(wanted[usable].mean())
    weight = np.where(wanted == 1, share / have, (1 - share) / (1 - have))
    even = np.where(wanted == 1, 0.5 / have, 0.5 / (1 - have))
    adam = Adam(model)
    epochs = min(MOST_EPOCHS, max(EPOCHS, -(-LEAST_STEPS * BATCH // len(fit))))
    for epoch in range(epochs):
        fit = rng.permutation(fit)
        for a in range(0, len(fit), BATCH):
            _step(model, adam, rng, table, words, bounds, fit[a : a + BATCH], wanted, even, RATE * (1 - epoch / (epochs + 1)))
    learnt, model.embedding = model.embedding, np.zeros((BUCKETS, DIMENSIONS), np.float32)
    model.embedding[live] = learnt[1:]
    own = np.concatenate([words[bounds[i] : bounds[i + 1]] for i in back])
    pool = pooled(model, whole, own, np.concatenate([[0], np.cumsum(np.diff(bounds)[back])]))
    logits = pool.astype(np.float64) @ model.dense + model.offset
    model.scale = _logistic(logits, wanted[back].astype(float), weight[back])
    scores = model.score(pool)
    model.threshold = best_threshold(scores, wanted[back], weight[back])
    for lang in {langs[i] for i in back} - {None}:
        rows = np.array([k for k, i in enumerate(back) if langs[i] == lang])
        if wanted[back][rows].sum() >= LEAST_PER_LANGUAGE:
            model.thresholds[lang] = best_threshold(scores[rows], wanted[back][rows], weight[back][rows])
    return model


def fold(doc_id: str = "doc_id"):
    """The fold of a row; fold 2 is held out."""
    return F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 4


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from all labelled documents outside the held-out fold."""
    spark = docs.sparkSession
    rows = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic")).filter(fold() != 2)
    n, positive = rows.agg(F.count("*"), F.sum(F.when(F.col("toxic") == 1, 1).otherwise(0))).first()
    share = (positive or 0) / n if n else 0.0
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(F.xxhash64("text").alias("hash"), lang.alias("lang"), "text").alias("own"))
    picked = keyed.join(rows, "doc_id").groupBy("doc_id", "toxic").agg(F.min("own").alias("own"))
    every, path = storage.staged_at(storage.in_arrow(picked.select("doc_id", "toxic", "own.lang", "own.text"), _bucketed, SAMPLE), "toxicity-labelled")
    held = {r.toxic: r for r in every.filter(F.col("toxic").isin(0, 1)).groupBy("toxic").agg(F.count("*").alias("n"), F.count_if(F.col("n_words") > 0).alias("usable"), F.sum("n_words").alias("words"), F.max("n_words").alias("longest")).collect()}
    of = lambda value, what: held[value][what] if value in held else 0
    at_once = of(1, "n") <= SAMPLE_POSITIVE and of(0, "n") <= SAMPLE_NEGATIVE and of(1, "words") + of(0, "words") <= SAMPLE_WORDS and max(of(1, "longest"), of(0, "longest")) <= SAMPLE_WORDS // 10
    learnt = every if at_once else every.filter(~_back())
    wanted = None
    for value, most in ((1, SAMPLE_POSITIVE), (0, SAMPLE_NEGATIVE)):
        part = storage.smallest_hashes(learnt.filter(F.col("toxic") == value).select("doc_id", "n_words"), "doc_id", most, of(value, "n"))
        wanted = part if wanted is None else wanted.unionByName(part)
    by_hash = Window.orderBy(F.xxhash64("doc_id"), "doc_id")  # of the few rows that start it
    short = wanted.filter(F.col("n_words") <= SAMPLE_WORDS // 10).select("doc_id", F.sum("n_words").over(by_hash).alias("words"))
    taken = learnt.join(F.broadcast(short.filter(F.col("words") <= SAMPLE_WORDS).select("doc_id")), "doc_id").coalesce(1)  # at most SAMPLE_POSITIVE + SAMPLE_NEGATIVE ids
    found = storage.staged(storage.in_arrow(taken, partial(_trained, share), "model binary"), "toxicity-model").first()
    model = pickle.loads(found[0]) if found else Model(np.zeros((BUCKETS, DIMENSIONS), np.float32), [np.zeros((w, DIMENSIONS, FILTERS), np.float32) for w in WIDTHS], [np.zeros(FILTERS, np.float32) for _ in WIDTHS], np.zeros(FILTERS * len(WIDTHS), np.float32), 0.0, constant=share)
    if isinstance(model, Model) and not at_once and of(0, "usable") and of(1, "usable"):
        model = _over_all(every.filter("n_words > 0 AND toxic IN (0, 1)"), model, share, of(1, "usable") / (of(0, "usable") + of(1, "usable")))
    storage.delete(spark, path)
    return model


def _back():
    """Whether a row is held back from the passes over all rows."""
    return F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(BACK)) == 0


def _over_all(every: DataFrame, start: Model, share: float, have: float) -> Model:
    """``start`` after ROUNDS passes over all rows but those held back, which then scale it and set its thresholds.

    ``share`` is the share of toxic rows among all labelled ones, ``have`` that among those with words.
    """
    learnt, back = every.filter(~_back()), every.filter(_back())
    counts = _summed(learnt, _counted)
    live = np.flatnonzero(np.concatenate([counts[k] for k in sorted(counts)]) >= LEAST_TEXTS)
    live = live[live > 0]
    model = start
    if start.constant is not None:
        model = _fresh(np.random.default_rng(SEED))
    else:  # buckets that were too rare at the start begin where the others did
        fresh, known = _fresh(np.random.default_rng(SEED)).embedding, start.embedding.any(1)
        model.embedding = np.where(known[:, None], start.embedding, fresh).astype(np.float32)
    rare = np.setdiff1d(np.arange(BUCKETS), live)
    model.embedding[rare] = 0
    for r in range(ROUNDS):
        sums = _summed(learnt, partial(_continued, every.sparkSession.sparkContext.broadcast((model, live)), have, ROUND_RATE * (1 - r / ROUNDS), r))
        model = _averaged(model, sums)
        model.embedding[rare] = 0
    shared = every.sparkSession.sparkContext.broadcast(model)  # of a fixed size
    logits = storage.in_arrow(back, partial(_logits, shared), "lang string, toxic int, step int")
    by_step = logits.groupBy("toxic", "step").agg(F.count("*").alias("n")).collect()  # as many as there are steps
    if len({r.toxic for r in by_step}) < 2:
        return model
    values = lambda rows, name: np.array([r[name] for r in rows], np.float64)
    toxic, own = values(by_step, "toxic"), values(by_step, "n")
    held = own[toxic == 1].sum() / own.sum()
    weigh = lambda t: np.where(t == 1, share / held, (1 - share) / (1 - held))
    model.scale = _logistic(values(by_step, "step") / LOGIT_STEPS, toxic, own * weigh(toxic))
    probability = lambda step: 1 / (1 + np.exp(-np.clip(model.scale[0] * step / LOGIT_STEPS + model.scale[1], -50, 50)))
    model.threshold = best_threshold(probability(values(by_step, "step")), toxic, own * weigh(toxic))
    langs = logits.groupBy("lang").agg(F.count_if(F.col("toxic") == 1).alias("n")).filter(F.col("lang").isNotNull() & (F.col("n") >= LEAST_PER_LANGUAGE)).select("lang")
    of_langs = {}
    for r in logits.join(langs, "lang").groupBy("lang", "toxic", "step").agg(F.count("*").alias("n")).toLocalIterator():
        of_langs.setdefault(r.lang, []).append(r)
    for lang, rows in of_langs.items():
        toxic = values(rows, "toxic")
        model.thresholds[lang] = best_threshold(probability(values(rows, "step")), toxic, values(rows, "n") * weigh(toxic))
    return model


SUMS = "slab int, task int, own binary"


def _summed(rows: DataFrame, function) -> dict[int, np.ndarray]:
    """By slab, the sums of the arrays that ``function`` gives in each task; every slab's arrays meet in a task of their
    own and are added up in the tasks' order."""

    def add(batch: pa.Table) -> pa.Table:
        batch = batch.sort_by("task")
        total = np.zeros(len(batch["own"][0].as_buffer()) // 8)
        for own in batch["own"]:
            total += np.frombuffer(own.as_buffer(), "<f8")
        return pa.table({"slab": batch["slab"].slice(0, 1), "own": pa.array([total.tobytes()], pa.binary())})

    found = storage.in_arrow(rows, function, SUMS).groupBy("slab").applyInArrow(add, "slab int, own binary").collect()  # of a fixed size
    return {r.slab: np.frombuffer(bytes(r.own), "<f8") for r in found}


def _slabs(arrays: dict[int, np.ndarray]) -> pa.RecordBatch:
    task = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays([pa.array(list(arrays), pa.int32()), pa.array([task] * len(arrays), pa.int32()), pa.array([a.astype("<f8").tobytes() for a in arrays.values()], pa.binary())], names=["slab", "task", "own"])


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(toxic, lang, table, words, bounds) of each batch of ``SAMPLE``."""
    for batch in (part for whole in batches for part in slices(whole, "buckets")):
        if batch.num_rows:
            yield np.array(batch["toxic"].to_pylist(), np.int64), batch["lang"], *_joined(batch["n_words"].to_pylist(), batch["buckets"].to_pylist())


def _texts_of_buckets(table: np.ndarray, words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    texts = np.zeros(BUCKETS, np.int64)
    for a, b in zip(bounds, bounds[1:]):
        texts[np.unique(table[np.unique(words[a:b])])] += 1
    return texts


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's texts of every bucket."""
    texts = np.zeros(BUCKETS, np.int64)
    for _, _, table, words, bounds in _decoded(batches):
        texts += _texts_of_buckets(table, words, bounds)
    yield _slabs({k: texts[k * SLAB : (k + 1) * SLAB] for k in range(BUCKETS // SLAB)})


def _continued(shared, have: float, rate: float, turn: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a task's rows change in the model, times the texts behind each change, and these texts."""
    start, live = shared.value
    number = np.zeros(BUCKETS, np.int64)
    number[live] = 1 + np.arange(len(live))
    model = Model(start.embedding[np.concatenate([[0], live])].copy(), [f.copy() for f in start.filters], [b.copy() for b in start.bias], start.dense.copy(), start.offset)
    adam, rng, n, texts = Adam(model), np.random.default_rng([SEED, turn, TaskContext.get().partitionId()]), 0, np.zeros(BUCKETS, np.int64)
    for wanted, _, table, words, bounds in _decoded(batches):
        texts += _texts_of_buckets(table, words, bounds)
        even, order = np.where(wanted == 1, 0.5 / have, 0.5 / (1 - have)), rng.permutation(len(wanted))
        n += len(order)
        for a in range(0, len(order), BATCH):
            _step(model, adam, rng, number[table], words, bounds, order[a : a + BATCH], wanted, even, rate)
    if not n:
        return
    moved = np.zeros((BUCKETS, DIMENSIONS))
    moved[live] = model.embedding[1:].astype(np.float64) - start.embedding[live]
    both = np.concatenate([texts[:, None], moved * texts[:, None]], 1)
    out = {k: both[k * SLAB : (k + 1) * SLAB] for k in range(BUCKETS // SLAB)}
    others = np.concatenate([np.ravel(p).astype(np.float64) - np.ravel(q) for p, q in zip(_others(model), _others(start))])
    yield _slabs(out | {BUCKETS // SLAB: np.concatenate([[n], n * others])})


def _others(model: Model) -> list[np.ndarray]:
    """All parameters but the buckets' vectors."""
    return [*model.filters, *model.bias, model.dense, np.array([model.offset])]


def _averaged(model: Model, sums: dict[int, np.ndarray]) -> Model:
    """The model after the changes of all tasks, each weighed by its texts."""
    both = np.concatenate([sums[k].reshape(SLAB, 1 + DIMENSIONS) for k in range(BUCKETS // SLAB)])
    embedding = (model.embedding + both[:, 1:] / np.maximum(both[:, :1], 1)).astype(np.float32)
    last = sums[BUCKETS // SLAB]
    moved, parts, at = last[1:] / last[0], [], 0
    for p in _others(model):
        parts.append((p + moved[at : at + p.size].reshape(p.shape)).astype(p.dtype))
        at += p.size
    return Model(embedding, parts[: len(WIDTHS)], parts[len(WIDTHS) : 2 * len(WIDTHS)], parts[-2], float(parts[-1][0]))


def _logits(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Held-back rows with their logits in whole steps."""
    m = shared.value
    for toxic, langs, table, words, bounds in _decoded(batches):
        logit = pooled(m, table, words, bounds).astype(np.float64) @ m.dense + m.offset
        steps = np.round(np.clip(logit, -50, 50) * LOGIT_STEPS).astype(np.int32)
        yield pa.RecordBatch.from_arrays([langs, pa.array(toxic, pa.int32()), pa.array(steps)], names=["lang", "toxic", "step"])


SAMPLE = "doc_id long, toxic int, lang string, n_words long, buckets binary"


def _bucketed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sampled texts as three numbers of 16 bits a word."""
    for batch in (part for whole in batches for part in slices(whole)):
        table, words, bounds = split_words(batch["text"])
        own = [table[words[a:b]].astype("<u2").tobytes() for a, b in zip(bounds.tolist(), bounds[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["toxic"], batch["lang"], pa.array(np.diff(bounds)), pa.array(own, pa.binary())], names=["doc_id", "toxic", "lang", "n_words", "buckets"])


def _joined(sizes: list[int], own: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts of ``_bucketed`` in the form of ``split_words``."""
    bounds = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    every = np.frombuffer(b"".join(own), "<u2").reshape(-1, 3)
    keys = every[:, 0].astype(np.int64)
    for k in (1, 2):
        keys *= BUCKETS
        keys += every[:, k]
    del every
    keys, words = np.unique(keys, return_inverse=True)
    table = np.stack([keys // BUCKETS**2, keys // BUCKETS % BUCKETS, keys % BUCKETS], 1)
    return table, words.astype(np.int32), bounds


def _trained(share: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row with the model that the sample trains."""
    columns = ("doc_id", "toxic", "lang", "n_words", "buckets")
    rows = sorted(r for batch in batches for r in zip(*(batch[c].to_pylist() for c in columns)))
    _, toxic, langs, sizes, own = zip(*rows) if rows else ([],) * 5
    del rows
    table, words, bounds = _joined(sizes, own)
    del own
    model = train(table, words, bounds, np.array(toxic, np.int64), list(langs), share)
    yield pa.RecordBatch.from_pydict({"model": pa.array([pickle.dumps(model)], pa.binary())})


def _scored(docs: DataFrame, model: Model) -> DataFrame:
    """(own, text, toxicity, toxic), ``own`` with all columns of ``docs`` but the text, whatever their names."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text"]  # the text goes to Python once
    own = docs.select((F.struct(*others) if others else F.lit(True)).alias("own"), "text", lang.alias("lang"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for batch in (part for whole in batches for part in slices(whole)):
            scores = m.score(pooled(m, *split_words(batch["text"])))
            limits = np.array([m.thresholds.get(x, m.threshold) for x in batch["lang"].to_pylist()])
            yield pa.RecordBatch.from_arrays([batch["own"], batch["text"], pa.array(scores, pa.float64()), pa.array(scores >= limits)], names=["own", "text", "toxicity", "toxic"])

    schema = StructType([own.schema["own"], own.schema["text"], StructField("toxicity", DoubleType()), StructField("toxic", BooleanType())])
    return storage.in_arrow(own, run, schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``toxicity`` (0 to 1) and ``toxic`` (at or over the threshold of the row's language)."""
    columns = [c for c in docs.columns if c not in ("toxicity", "toxic")]
    return _scored(docs, model).select(*[F.col("text") if c == "text" else F.col(f"own.`{c}`").alias(c) for c in columns], "toxicity", "toxic")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents below the threshold of their language, with all their columns whatever their names."""
    return _scored(docs, model).filter(~F.col("toxic")).select(*[F.col("text") if c == "text" else F.col(f"own.`{c}`").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: every document's score."""
    docs = storage.documents(spark, sf_dir)
    model = fit(docs, storage.documents(spark, sf_dir, "labels"))
    out = score(docs.select("doc_id", "text", "lang"), model)
    return out.select("doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"), (F.col("toxicity") >= THRESHOLD).cast("int").alias("predicted"))
