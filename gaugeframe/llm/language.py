"""Language of documents by rank-order profiles of character n-grams.

A profile lists the most frequent n-grams (one to three characters; words are padded with one
blank on each side) from rank 0 on. A document's profile is compared with each language's: an
n-gram counts the distance of its two ranks, or the profile length if the language lacks it. The
language with the smallest sum, the out-of-place distance, is predicted.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.llm.rows import crc32_fold

PROFILE = 400
# Documents per language that profiles are learned from, about; drawn by a hash of the id.
SAMPLE = 3_000
FOLDS, HELD_OUT = 3, 1
BITS = np.uint64(21)


def letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool)


def ngrams(text: str | None, is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams of a text, as integers, and their counts. All else than letters is one
    blank; n-grams of blanks alone are left out."""
    if not text:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    codes = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(is_letter[codes], codes, 0).astype(np.uint64)
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    one = codes[keep]
    if not one.any():
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    two = (one[:-1] << BITS) | one[1:]
    three = (two[:-1] << BITS) | one[2:]
    # The length is part of the number, since a blank is 0.
    return np.unique(np.concatenate([
        one[one > 0] << np.uint64(0), two | np.uint64(1 << 42),
        three[one[1:-1] > 0] | np.uint64(1 << 63)]), return_counts=True)


def profile(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, ties by number."""
    return keys[np.lexsort((keys, -counts))[:size]]


@dataclass(frozen=True)
class Profiles:
    """Languages in order, all their n-grams sorted, and each language's rank of each of them."""

    languages: list[str]
    keys: np.ndarray
    ranks: np.ndarray
    size: int

    def predict(self, text: str | None, is_letter: np.ndarray) -> tuple[str, float]:
        """The nearest language and how much nearer it is than the mean of the others."""
        keys, counts = ngrams(text, is_letter)
        if not len(keys) or not self.languages:
            return "und", 0.0
        mine = profile(keys, counts, self.size)
        at = np.minimum(np.searchsorted(self.keys, mine), len(self.keys) - 1)
        known = self.keys[at] == mine
        place = np.arange(len(mine))
        far = np.where(known, np.abs(self.ranks[:, at] - place), self.size)
        far[(self.ranks[:, at] == self.size) & known] = self.size
        total = far.sum(1) / (len(mine) * self.size)
        best = int(np.argmin(total))
        if len(total) == 1:
            return self.languages[0], float(1 - total[0])
        rest = (total.sum() - total[best]) / (len(total) - 1)
        return self.languages[best], float(min(1.0, max(0.0, 1 - total[best] / rest))) if rest else 0.0


def fit_profiles(docs: DataFrame, size: int = PROFILE, sample: int = SAMPLE) -> Profiles:
    """Learn from ``docs (doc_id, text, lang)`` outside the held-out fold.

    Rows without id, text or lang teach nothing. About ``sample`` documents of each language are
    used, whole; the driver gets ``size`` n-grams per language.
    """
    known = docs.where((crc32_fold("doc_id", FOLDS) != HELD_OUT) & F.col("lang").isNotNull())
    share = known.groupBy("lang").agg((F.lit(float(sample)) / F.count("*")).alias("share"))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    # One row per language.
    chosen = known.join(F.broadcast(share), "lang").where(draw < F.col("share")).select("lang", "text")

    def run(batches):
        is_letter = letters()
        for batch in batches:
            found: dict[str, list] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found.setdefault(lang, []).append(ngrams(text, is_letter))
            for lang, parts in found.items():
                keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                n = np.bincount(at, np.concatenate([c for _, c in parts]), len(keys))
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)),
                    pa.array(n.astype(np.int64))], names=["lang", "gram", "n"])

    grams = chosen.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(
        F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = grams.withColumn("place", F.row_number().over(order)).where(F.col("place") <= size)
    rows = top.select("lang", "gram", (F.col("place") - 1).alias("rank")).collect()
    languages = sorted({r["lang"] for r in rows}, key=lambda v: v.encode())
    keys = np.unique(np.array([r["gram"] for r in rows], np.int64).view(np.uint64))
    ranks = np.full((len(languages), len(keys)), size, np.int64)
    for r in rows:
        key = np.int64(r["gram"]).view(np.uint64)
        ranks[languages.index(r["lang"]), np.searchsorted(keys, key)] = r["rank"]
    return Profiles(languages, keys, ranks, size)


def identify_language(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` per row of ``docs (doc_id, text, lang)``.

    ``lang_pred`` is a learned language, or ``und`` for a text that is null or has no letter and
    where nothing was learned. ``score`` (0 to 1) grows with the distance of the other languages.
    ``held_out`` marks the fold from which nothing is learned (null for a row without an id).
    Ties go to the first language by code point; repeated rows get equal rows; other columns
    are not looked at.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.col("lang").cast("string").alias("lang"))
    profiles = fit_profiles(docs)

    def run(batches):
        is_letter = letters()
        for batch in batches:
            found = [profiles.predict(t, is_letter) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([f[0] for f in found], pa.string()),
                pa.array([f[1] for f in found], pa.float64())], names=["doc_id", "lang_pred", "score"])

    out = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return out.select("doc_id", (crc32_fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
                      "lang_pred", "score")
