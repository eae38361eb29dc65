"""Toxicity scores from positive-unlabelled learning.

Confirmed toxic documents are the positives; every other text, labelled or not, is unlabelled.
With class prior p the risk of a classifier is

    p * R(positive as 1) + max(0, R(unlabelled as 0) - p * R(positive as 0)),

where the second term, the risk of the negatives that cannot be seen, is kept from falling below
zero: when it does, the step goes against its gradient, which undoes the overfitting.

Features are the words of a document and their beginnings of 4 to 6 characters, present or not.
Spark counts them over the training sample; kept are those much more frequent among positives. The
risk is minimised in numpy by one task, which gets the numbers of the kept features of each
document and no text. The level of decision is then set by a criterion that needs no negatives
either: the largest recall squared over the share called toxic (``decision_level``).
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.llm.rows import crc32_fold
from gaugeframe.llm.text import in_parts, letter_words, utf8
from gaugeframe.sources.scratch import materialize

# Bounds of the training sample; drawn by a hash of the document id.
POSITIVES, UNLABELLED = 6_000, 18_000
FEATURES = 3_000
# Log-likelihood ratio from which a feature counts; chance passes it once in some 10^4 features.
LEAST_GAIN = 8.0
# How many times as frequent among positives as among the rest a feature must be.
LEAST_LIFT = 25.0
FOLDS = 5
# Features that a task counts before it passes the counts on.
HELD = 200_000
# Words whose weights a task remembers.
CACHED = 100_000
PREFIXES = (4, 5, 6)


def features(data: bytes | None) -> set[bytes]:
    """Distinct words and word beginnings; a beginning is marked by a trailing space."""
    words = set(letter_words(data))
    out = set(words)
    for n in PREFIXES:
        out.update([w[:n] + b" " for w in words if len(w) > n])
    return out


@dataclass(frozen=True)
class Classifier:
    bias: float
    weights: dict[bytes, float]

    def scores(self, texts: list[bytes | None]) -> np.ndarray:
        known: dict[bytes, float] = {}
        out = np.empty(len(texts))
        get, weight = known.get, self.weights.get
        for k, data in enumerate(texts):
            # Words are looked up once per task; beginnings count once per document.
            total, seen = self.bias, set()
            for word in set(letter_words(data)):
                found = get(word)
                if found is None:
                    names = [word, *[word[:n] + b" " for n in PREFIXES if len(word) > n]]
                    found = known[word] = tuple(f for f in names if f in self.weights)
                if found:
                    seen.update(found)
            for f in seen:
                total += weight(f)
            out[k] = total
            if len(known) > CACHED:
                known.clear()
        return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def _counts(batches):
    """``(feature, seen, other)``: in how many positive and other texts; parts of the sums."""
    names = ["feature", "seen", "other"]
    seen, other = Counter(), Counter()

    def parts():
        found = list(seen.keys() | other.keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(found, pa.binary()), pa.array([seen[f] for f in found], pa.int64()),
             pa.array([other[f] for f in found], pa.int64())], names=names)
        seen.clear()
        other.clear()
        return out

    for batch in in_parts(batches, 0):
        for data, toxic in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
            (seen if toxic else other).update(features(data))
            if len(seen) + len(other) > HELD:
                yield parts()
    yield parts()


def _ratio(p: int, u: int, prior: float) -> tuple[Column, Column]:
    """The log-likelihood ratio and the lift of a feature, from its counts among ``p`` positives
    (``seen``) and ``u`` unlabelled texts (``other``).

    The ratio compares one common frequency with a frequency for each sample, so a small sample
    teaches only what it shows beyond doubt. What the positives hidden among the unlabelled
    explain is not held against a feature.
    """
    seen = F.col("seen").cast("double")
    rest = F.greatest(F.lit(0.0), F.col("other") - F.lit(prior * u / p) * seen)

    def part(k, n, q):
        q = F.least(F.greatest(q, F.lit(1e-12)), F.lit(1 - 1e-12))
        return k * F.log(q) + (F.lit(float(n)) - k) * F.log1p(-q)

    both = (seen + rest) / (p + u)
    ratio = part(seen, p, seen / p) + part(rest, u, rest / u) - part(seen, p, both) - part(rest, u, both)
    return ratio, (seen / p) >= LEAST_LIFT * (rest / u)


def choose_features(counts: DataFrame, p: int, u: int, prior: float) -> list[bytes]:
    """The features of ``counts (feature, seen, other)`` that are more frequent among positives
    than chance would make them: at most ``FEATURES``, the surest first."""
    ratio, lifted = _ratio(p, u, prior)
    fit = counts.where("seen > 2").withColumn("ratio", ratio).where(
        (F.col("ratio") > LEAST_GAIN) & lifted)
    best = fit.orderBy(F.desc("ratio"), "feature").limit(FEATURES).select("feature")
    return [bytes(r[0]) for r in best.collect()]


@dataclass(frozen=True)
class Presence:
    """Which features each document of a sample has: flat feature numbers and their documents."""

    feature: np.ndarray
    owner: np.ndarray
    documents: int
    features: int

    @classmethod
    def of(cls, rows: list, features: int) -> Presence:
        sizes = np.fromiter(map(len, rows), np.int64, len(rows))
        flat = np.concatenate([np.empty(0, np.int32), *rows]).astype(np.int32)
        return cls(flat, np.repeat(np.arange(len(rows), dtype=np.int32), sizes), len(rows), features)

    def margins(self, weights: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights[self.feature], self.documents)

    def gradient(self, slopes: np.ndarray) -> np.ndarray:
        """The mean over documents of slope times presence, the bias last."""
        sums = np.bincount(self.feature, slopes[self.owner], self.features)
        return np.append(sums, slopes.sum()) / max(1, self.documents)


def train_nnpu(positive: Presence, unlabelled: Presence, prior: float,
               epochs: int = 150, rate: float = 0.1, decay: float = 1e-3):
    """Weights and bias of a linear classifier by the non-negative risk, logistic loss, Adam."""
    w = np.zeros(positive.features + 1)
    w[-1] = np.log(prior / (1 - prior))
    m, v = np.zeros_like(w), np.zeros_like(w)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    loss = lambda z: np.logaddexp(0, z)  # noqa: E731  of the label 0 at margin z
    for step in range(1, epochs + 1):
        zp, zu = positive.margins(w[:-1]) + w[-1], unlabelled.margins(w[:-1]) + w[-1]
        hidden = loss(zu).mean() - prior * loss(zp).mean()
        g_hidden = unlabelled.gradient(sig(zu)) - prior * positive.gradient(sig(zp))
        g = prior * positive.gradient(sig(zp) - 1) + g_hidden if hidden >= 0 else -g_hidden
        g[:-1] += decay * w[:-1]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w[:-1], w[-1]


def decision_level(zp: np.ndarray, zu: np.ndarray) -> float:
    """The margin at which recall squared over the share called toxic is largest.

    This criterion needs no negatives: it grows with the F1 score on the true classes.
    """
    zp, zu = np.sort(zp), np.sort(zu)
    levels = np.unique(np.concatenate([zp, zu]))
    cuts = (levels[1:] + levels[:-1]) / 2
    if not len(cuts):
        return 0.0
    recall = 1 - np.searchsorted(zp, cuts) / len(zp)
    called = np.maximum(1 - np.searchsorted(zu, cuts) / len(zu), 0.5 / len(zu))
    return float(cuts[np.argmax(recall**2 / called)])


def _numbers(chosen: list[bytes]):
    """``(doc_id, toxic, found)``: the numbers of the chosen features in each text."""
    wanted = {f: k for k, f in enumerate(chosen)}

    def run(batches):
        for batch in in_parts(batches, 0):
            found = [sorted(wanted[f] for f in features(data) & wanted.keys())
                     for data in utf8(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(2), batch.column(1), pa.array(found, pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "found"])

    return run


def _trained(prior: float, count: int):
    def run(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values(["doc_id", "toxic"], kind="stable")
        toxic = sample["toxic"].to_numpy() > 0
        positive, unlabelled = (Presence.of(list(sample["found"][m]), count) for m in (toxic, ~toxic))
        w, _ = train_nnpu(positive, unlabelled, prior)
        level = decision_level(positive.margins(w), unlabelled.margins(w))
        return pd.DataFrame({"feature": np.arange(-1, count), "weight": [-level, *w]})

    return run


def fit_toxicity(docs: DataFrame, labels: DataFrame, prior: float | None = None) -> Classifier:
    """Learn from ``docs (doc_id, text)`` and ``labels (doc_id, toxic)`` outside fold 0.

    The prior is given, or the share of toxic rows among those labelled (0.01 to 0.5). At most
    about ``POSITIVES`` toxic and ``UNLABELLED`` other documents are used, at every size of table.
    Of repeated labels the largest counts; rows without id, label or text teach nothing. Without
    positives, other documents or telling features every text scores the prior.
    """
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                          F.col("toxic").cast("int").alias("toxic")).where(
        (crc32_fold("doc_id", FOLDS) != 0) & F.col("toxic").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    total, toxic = marks.agg(F.count("*"), F.coalesce(F.sum(
        (F.col("toxic") > 0).cast("long")), F.lit(0))).head()
    prior = prior or min(0.5, max(0.01, toxic / total if total else 0.1))
    untaught = Classifier(float(np.log(prior / (1 - prior))), {})
    if not toxic:
        return untaught
    draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30)) / float(1 << 30)
    # The bounded sample of positives' ids is what is broadcast.
    known = F.broadcast(marks.where((F.col("toxic") > 0) & (draw < POSITIVES / toxic)).select(
        "doc_id", F.lit(1).alias("toxic")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("binary").alias("data")).where(
        (crc32_fold("doc_id", FOLDS) != 0) & F.col("data").isNotNull())
    share = UNLABELLED / max(1, docs.count())
    sample = materialize(texts.join(known, "doc_id", "left").select(
        "data", F.coalesce("toxic", F.lit(0)).alias("toxic"), "doc_id").where(
            (F.col("toxic") == 1) | (draw < share)), "sample")
    p, n = sample.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).head()
    if not p or p == n:
        return untaught
    counts = sample.select("data", "toxic").mapInArrow(
        _counts, "feature binary, seen long, other long").groupBy("feature").agg(
            F.sum("seen").alias("seen"), F.sum("other").alias("other"))
    chosen = choose_features(counts, p, n - p, prior)
    if not chosen:
        return untaught
    rows = sample.mapInArrow(_numbers(chosen), "doc_id long, toxic int, found array<int>")
    # One task: at most the sample's rows, each with numbers of chosen features only.
    found = rows.groupBy().applyInPandas(
        _trained(prior, len(chosen)), "feature int, weight double").collect()
    weights = {r["feature"]: r["weight"] for r in found}
    return Classifier(weights[-1], {f: weights[k] for k, f in enumerate(chosen)})


def with_toxicity(docs: DataFrame, model: Classifier, score: str = "score") -> DataFrame:
    """``docs`` with a column of scores from 0 to 1; null and empty texts get a score too."""
    schema = T.StructType([*docs.schema.fields, T.StructField(score, T.DoubleType())])
    at = docs.columns.index("text")

    def run(batches):
        for batch in in_parts(batches, at):
            scores = model.scores(utf8(batch.column(at)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(scores, pa.float64())],
                names=[*batch.schema.names, score])

    return docs.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` per row of ``docs``; predicted is 1 from 0.5 on.

    ``held_out`` marks fold 0, from whose labels and texts nothing is learned; it is null for a
    row without an id. Repeated rows get equal rows; other columns are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = with_toxicity(docs, fit_toxicity(docs, labels))
    return scored.select("doc_id", (crc32_fold("doc_id", FOLDS) == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))
