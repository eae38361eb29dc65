"""Importance resampling: which raw documents look most like the target texts.

Words and word pairs are hashed into buckets. Two generative models, the bucket shares of target
texts and of all texts, give each document the log-ratio of its probability under both. Adding a
Gumbel number per document and keeping the k largest draws k documents without replacement, in
proportion to the ratios.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from gaugeframe.functions.order_stats import exact_quantiles
from gaugeframe.llm.rows import sized
from gaugeframe.llm.text import letter_words, mix, utf8
from gaugeframe.sources.scratch import materialize

BUCKETS = 10_000


def _buckets(data: bytes | None) -> np.ndarray:
    words = letter_words(data)
    one = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    two = mix(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])
    return (np.concatenate([one, two]) % np.uint64(BUCKETS)).astype(np.int64)


def _counts(batches):
    total = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for data, target in zip(utf8(batch.column(0)), batch.column(1).to_pylist()):
            n = np.bincount(_buckets(data), minlength=BUCKETS)
            total[0] += n
            total[1] += n if target else 0
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(BUCKETS)), pa.array(total[0]), pa.array(total[1])],
        names=["bucket", "raw", "target"])


def resample(docs: DataFrame, labels: DataFrame, share: float = 0.5, seed: int = 4) -> DataFrame:
    """``(doc_id, log_ratio, noisy, selected)`` per row of ``docs (doc_id, text)``.

    Target texts are those with ``quality`` 1 in ``labels``; counts cover all documents. The
    ``share`` of rows with the largest ``noisy`` value is selected: ceil(share * rows) of them, and
    more only where values tie at the cut. Rows that share a doc_id get the same Gumbel number, so
    equal copies stand or fall together. Null and blank texts have ratio 0. Other columns of
    ``docs`` are not looked at. Without rows or without labelled texts nothing fails: an empty
    table gives an empty result, and no target texts leave both models with the add-one counts.
    """
    good = materialize(labels.where("quality = 1 AND doc_id IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("good")).distinct(), "good")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    marked = rows.join(sized(good), rows["doc_id"] == F.col("good"), "left").select(
        "text", F.col("good").isNotNull().alias("target"))
    found = marked.mapInArrow(_counts, "bucket long, raw long, target long").groupBy("bucket").agg(
        F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect()  # a row per bucket
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    for r in found:
        raw[r["bucket"]] += r["raw"]
        target[r["bucket"]] += r["target"]
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())

    def run(batches):
        for batch in batches:
            score = [float(ratio[_buckets(d)].sum()) for d in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score, pa.float64())], names=["doc_id", "log_ratio"])

    unit = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    scored = rows.mapInArrow(run, "doc_id long, log_ratio double").withColumn(
        "noisy", F.col("log_ratio") - F.log(-F.log(unit)))
    scored = materialize(scored, "scored")
    total = scored.count()
    k = min(total, math.ceil(share * total))
    if not k:
        return scored.withColumn("selected", F.lit(False))
    # Half way between the k-th largest value and the next below it, so rounding moves no row.
    rank = max(total - k - 0.5, 0) / max(total - 1, 1)
    cut = exact_quantiles(scored, ["noisy"], [rank])["noisy"][0]
    return scored.withColumn("selected", F.col("noisy") >= F.lit(cut))
