"""Passages: stretches of words that stand in several texts, wherever their lines begin.

A passage of ``LONG`` words or more is found inside longer lines and across lines. Places to look at
are chosen by content: of every ``REACH`` neighbouring groups of five words the one with the smallest
hash is an anchor, so equal stretches have the same anchors. The ``LONG - REACH + 1`` words from an
anchor on are one unit, and its hash is its key. Any stretch of ``LONG`` words has an anchor among
its first ``REACH`` groups, and so a whole unit: none is missed. A unit that only shorter stretches
share (of ``LONG - REACH + 1`` words at least) counts too.

Of each key only the smallest and largest row go through the first shuffle; keys with two different
rows are then joined with their places, where Spark can split a very frequent key.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from gaugeframe.llm.rows import sized
from gaugeframe.llm.text import in_parts, mix, space_words, utf8
from gaugeframe.sources.scratch import materialize

LONG, REACH, GROUP = 51, 16, 5
CHUNK = 1 << 18  # words that are hashed at once; a longer text is a chunk of its own
# An odd base, so that it has an inverse among the 64-bit integers.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


def _slid(x: np.ndarray, size: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``size`` neighbours, in doubling steps."""
    width, out = 1, x
    while 2 * width <= size:
        out, width = pick(out[:-width], out[width:]), 2 * width
    rest = size - width
    return pick(out[: len(out) - rest], out[rest:]) if rest else out


def units(
    words: list[bytes], text: np.ndarray, long: int = LONG, reach: int = REACH
) -> tuple[np.ndarray, np.ndarray]:
    """The first words and the keys of the units of some texts.

    ``text`` numbers the text of each word, ascending; words of a text are together.
    """
    size, span = long - reach + 1, reach + GROUP - 1
    n = len(words)
    if n < max(size, span):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    codes = np.fromiter(map(xxh64_intdigest, words), np.uint64, n)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(codes * _powers(_BASE, n))])
    back = _powers(_INVERSE, n)

    def folded(width: int) -> np.ndarray:
        """A hash of every ``width`` neighbours, from differences of prefix sums."""
        return mix((sums[width:] - sums[:-width]) * back[: n - width + 1] + np.uint64(width))

    groups = folded(GROUP)
    # The smallest group of every stretch that lies in one text; elsewhere nothing is chosen.
    least = _slid(groups, reach, np.minimum)
    least[text[: len(least)] != text[span - 1 :]] = 0
    edge = np.zeros(reach - 1, np.uint64)
    # A group is an anchor if it is the smallest of any stretch that holds it.
    chosen = _slid(np.concatenate([edge, least, edge]), reach, np.maximum) == groups
    chosen[n - size + 1 :] = False
    anchors = np.flatnonzero(chosen)
    anchors = anchors[text[anchors] == text[anchors + size - 1]]
    return anchors, folded(size)[anchors].view(np.int64)


def _units(long: int, reach: int):
    def part(rows: list[int], texts: list[list[bytes]]) -> pa.RecordBatch:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        text = np.repeat(np.arange(len(texts)), sizes)
        at, keys = units([w for words in texts for w in words], text, long, reach)
        own = text[at]
        first = np.cumsum(sizes) - sizes
        return pa.RecordBatch.from_arrays(
            [pa.array(np.array(rows, np.int64)[own]), pa.array((at - first[own]).astype(np.int32)),
             pa.array(keys)], names=["row", "start", "key"])

    def run(batches):
        for batch in in_parts(batches, 1):
            rows, texts, held = [], [], 0
            for row, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                rows.append(row)
                texts.append(space_words(data))
                held += len(texts[-1])
                if held > CHUNK:
                    yield part(rows, texts)
                    rows, texts, held = [], [], 0
            if rows:
                yield part(rows, texts)

    return run


def _joined(starts: str, size: int):
    """``(start, end)`` of units that overlap or touch, joined; ``starts`` is sorted."""
    empty = F.array().cast("array<struct<start:int,end:int>>")
    last = lambda acc: F.element_at(acc, -1)
    return F.aggregate(
        starts, empty,
        lambda acc, at: F.when(
            (F.size(acc) > 0) & (at <= last(acc)["end"]),
            F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(
                F.struct(last(acc)["start"].alias("start"), (at + size).alias("end"))))
        ).otherwise(F.concat(acc, F.array(F.struct(at.alias("start"), (at + size).alias("end"))))))


def repeated_passages(
    texts: DataFrame, long: int = LONG, reach: int = REACH, later_only: bool = False
) -> DataFrame:
    """``(row, passages)`` of ``texts (row, text)`` that share a passage with another row.

    ``passages`` lists ``(start, end)`` in words (runs without ASCII white space, A-Z lower-cased),
    sorted, the end exclusive; overlapping units are joined. Every stretch of ``long`` words that
    another row holds is covered by a passage, but for up to ``reach`` - 1 words at each end; a
    passage has at least ``long - reach + 1`` words. ``row`` is a long without nulls. Null and
    short texts have no passages.

    ``later_only`` lists only what a smaller row holds too: cut from the texts, each passage stays
    once, in the smallest row.
    """
    found = materialize(texts.select("row", "text").mapInArrow(
        _units(long, reach), "row long, start int, key long"), "units")
    several = found.groupBy("key").agg(F.min("row").alias("low"), F.max("row").alias("high"))
    several = several.where("low < high")
    if later_only:
        several = materialize(several.select("key", "low"), "shared-units")
        places = found.join(several, "key").where("low < row")
    else:
        # Sent to every executor only up to a counted size; beyond it both sides are shuffled.
        places = found.join(sized(materialize(several.select("key"), "shared-units")), "key",
                            "left_semi")
    places = places.groupBy("row").agg(F.array_sort(F.collect_list("start")).alias("starts"))
    return places.select("row", _joined("starts", long - reach + 1).alias("passages"))


_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def cut_words(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    """A text without the words of ``spans``, and without the white space inside of them."""
    words = [m.span() for m in _WORD.finditer(data)]
    out, at = [], 0
    for start, end in spans:
        out.append(data[at : words[start][0]])
        at = words[end - 1][1]
    return b"".join([*out, data[at:]])


def without_passages(rows: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``rows`` with all columns, their texts without the passages that a row of a smaller ``key`` (a
    long, without nulls or repeats) holds too."""
    found = repeated_passages(
        rows.select(F.col(key).alias("row"), F.col(text).alias("text")), later_only=True)
    found = materialize(found.select(
        F.col("row").alias("__gf_at"), F.col("passages").alias("__gf_spans")), "passages")
    joined = rows.join(found, rows[key] == F.col("__gf_at"), "left").drop("__gf_at")
    names = rows.columns
    at = names.index(text)

    def run(batches):
        for batch in batches:
            data = utf8(batch.column(at))
            for k, spans in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if spans:
                    data[k] = cut_words(data[k], [(p["start"], p["end"]) for p in spans])
            columns = batch.columns[:-1]
            columns[at] = pa.array(data, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, rows.schema)
