"""The parts of the toxicity training against plain versions, and its memory."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gaugeframe.llm import toxicity as tox
from gaugeframe.llm.toxicity import Presence, choose_features, decision_level, train_nnpu


def batch(rows):
    return pa.RecordBatch.from_arrays(
        [pa.array([t for t, _ in rows], pa.binary()), pa.array([y for _, y in rows], pa.int32())],
        names=["data", "toxic"])


def brute_level(zp, zu):
    """The middle of two neighbouring margins with the largest recall^2 / share called."""
    levels = sorted({*zp, *zu})
    best = None
    for low, high in zip(levels, levels[1:]):
        cut = (low + high) / 2
        recall = sum(z >= cut for z in zp) / len(zp)
        called = max(sum(z >= cut for z in zu) / len(zu), 0.5 / len(zu))
        if best is None or recall**2 / called > best[0]:
            best = recall**2 / called, cut
    return best[1] if best else 0.0


@pytest.mark.parametrize("seed", range(8))
def test_level_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    zp, zu = (rng.integers(-3, 6, 20) / 2).tolist(), (rng.integers(-6, 4, 60) / 2).tolist()
    assert decision_level(np.array(zp), np.array(zu)) == brute_level(zp, zu)
    assert decision_level(np.ones(3), np.ones(4)) == 0.0


def test_features_equal_those_counted_directly(spark):
    rng = random.Random(2)
    rows = []
    for k in range(900):
        words = [f"w{rng.randrange(300)}" for _ in range(20)]
        if k % 9 == 0:
            words += rng.sample(["bad", "worse", "worst", "foulest"], 2)
        rows.append((" ".join(words).encode(), int(k % 9 == 0)))
    p, u, prior = 100, 800, 0.12
    seen, other = tox.Counter(), tox.Counter()
    for data, toxic in rows:
        (seen if toxic else other).update(tox.features(data))
    want = []
    for f, k in seen.items():
        rest = max(0.0, other[f] - prior * u * k / p)
        part = lambda k, n, q: k * np.log(min(max(q, 1e-12), 1 - 1e-12)) + (
            n - k) * np.log1p(-min(max(q, 1e-12), 1 - 1e-12))
        both = (k + rest) / (p + u)
        ratio = part(k, p, k / p) + part(rest, u, rest / u) - part(k, p, both) - part(rest, u, both)
        if k > 2 and ratio > tox.LEAST_GAIN and k / p >= tox.LEAST_LIFT * rest / u:
            want.append(f)
    df = spark.createDataFrame(rows, "data binary, toxic int").repartition(3)
    counts = df.mapInArrow(tox._counts, "feature binary, seen long, other long").groupBy(
        "feature").agg(F.sum("seen").alias("seen"), F.sum("other").alias("other"))
    assert sorted(choose_features(counts, p, u, prior)) == sorted(want) and b"foulest" in want


def test_training_equals_a_dense_version():
    rng = np.random.default_rng(1)
    x, z = (rng.random((n, 12)) < 0.2 for n in (40, 200))
    sparse = lambda m: Presence.of([np.flatnonzero(r) for r in m], 12)
    w, b = train_nnpu(sparse(x), sparse(z), 0.2)

    v, m1, m2 = np.append(np.zeros(12), np.log(0.2 / 0.8)), np.zeros(13), np.zeros(13)
    x1, z1 = (np.hstack([m, np.ones((len(m), 1))]) for m in (x, z))
    sig = lambda t: 1 / (1 + np.exp(-t))
    for step in range(1, 151):
        zp, zu = x1 @ v, z1 @ v
        hidden = np.logaddexp(0, zu).mean() - 0.2 * np.logaddexp(0, zp).mean()
        g_hidden = z1.T @ sig(zu) / 200 - 0.2 * x1.T @ sig(zp) / 40
        g = 0.2 * x1.T @ (sig(zp) - 1) / 40 + g_hidden if hidden >= 0 else -g_hidden
        g = g + 1e-3 * np.append(v[:-1], 0)
        m1, m2 = 0.9 * m1 + 0.1 * g, 0.999 * m2 + 0.001 * g * g
        v = v - 0.1 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
    assert np.allclose(np.append(w, b), v, atol=1e-9)


def test_counting_stays_small_with_ever_new_words():
    """Positives with 3,000 words each that nobody else has."""
    def batches():
        for k in range(200):
            words = b" ".join(b"n%dx%d" % (k, i) for i in range(3_000))
            yield batch([(words, 1)])

    tracemalloc.start()
    total = sum(part.num_rows for part in tox._counts(batches()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total >= 200 * 3_000
    assert peak < 120e6


def test_training_stays_small_at_its_bounds():
    rng = np.random.default_rng(3)
    rows = lambda n: [rng.integers(0, tox.FEATURES, 30) for _ in range(n)]
    positive, unlabelled = rows(tox.POSITIVES), rows(tox.UNLABELLED)
    tracemalloc.start()
    train_nnpu(Presence.of(positive, tox.FEATURES), Presence.of(unlabelled, tox.FEATURES), 0.1,
               epochs=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60e6


def test_scores_at_the_cut_count_as_toxic(spark):
    docs = spark.createDataFrame([(1, "x"), (2, None), (3, "")], "doc_id long, text string")
    scored = tox.with_toxicity(docs, tox.Classifier(0.0, {})).collect()
    assert [r["score"] for r in scored] == [0.5] * 3


def test_a_very_long_text_and_repeated_labels(spark):
    long = " ".join(f"w{k % 5_000}" for k in range(300_000))
    docs = spark.createDataFrame([(1, long), (1, long), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 0)], "doc_id long, toxic int")
    assert tox.toxicity(docs, labels).count() == 3
