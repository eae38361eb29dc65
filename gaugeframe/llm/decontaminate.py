"""Benchmark passages in documents, found with a positional inverted index.

An item is cut into windows of ten consecutive words. Over the training text:

1. Count the benchmark's terms (one pass, sums per term).
2. Order each window's terms from the rarest on. The two rarest are its anchors.
3. Store postings ``(term, text, position)``. A full index of common terms would be larger than
   the text, so by default positions are stored only where both anchors of some window stand at
   their distance; ``build_postings`` stores every position of the terms that it is given.
4. Intersect: the rarest term's positions, less its offset, are possible starts; a start stays
   if each other term of the window has a posting at its own offset.

Texts are identified by a 128-bit digest, so equal copies are indexed once. Windows are worked
off in slices of at most ``SLICE_WINDOWS``; a slice's vocabulary is what each task holds.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.text import in_parts, letter_words, utf8
from gaugeframe.sources.scratch import materialize

WINDOW = 10
SLICE_WINDOWS = 100_000
# Longer words are replaced by a digest, which bounds the vocabulary's bytes.
LONG_TERM = 64
POSTING = "term int, text_key binary, pos int"


def _term(word: bytes) -> bytes:
    return word if len(word) <= LONG_TERM else b"\x00" + xxhash.xxh128_digest(word)


def _windows(size: int):
    schema = pa.schema([("item_id", pa.string()), ("window_key", pa.binary()),
                        ("terms", pa.list_(pa.binary()))])

    def run(batches):
        for batch in batches:
            ids, keys, terms = [], [], []
            for item, data in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                words = [_term(w) for w in letter_words(data)]
                for k in range(max(1, len(words) - size + 1) if words else 0):
                    part = words[k : k + size]
                    ids.append(item), terms.append(part)
                    keys.append(xxhash.xxh128_digest(b" ".join(part)))
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.string()), pa.array(keys, pa.binary()),
                pa.array(terms, pa.list_(pa.binary()))], schema=schema)

    return run


def _term_ids(vocabulary: dict[bytes, int]):
    """A function from text to the term number at each position, -1 for other words."""
    long_terms = any(w[:1] == b"\x00" for w in vocabulary)

    def ids(data: bytes | None) -> np.ndarray:
        words = letter_words(data)
        if long_terms:
            words = [_term(w) for w in words]
        return np.fromiter(map(vocabulary.get, words, repeat(-1)), np.int32, len(words))

    return ids


def _counts(vocabulary: dict[bytes, int]):
    schema = pa.schema([("term", pa.int32()), ("n", pa.int64())])

    def run(batches):
        ids, total = _term_ids(vocabulary), np.zeros(len(vocabulary) + 1, np.int64)
        for batch in in_parts(batches, 0):
            for data in utf8(batch.column(0)):
                total += np.bincount(ids(data) + 1, minlength=len(total))
        used = np.flatnonzero(total[1:])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(total[1:][used], pa.int64())], schema=schema)

    return run


class Anchors:
    """Per rarest term the windows' second rarest terms, as arrays sorted by the first."""

    def __init__(self, windows: list[np.ndarray], count: np.ndarray):
        rows = set()
        self.first = []
        for terms in windows:
            order = sorted(range(len(terms)), key=lambda k: (count[terms[k]], k))
            a, b = order[0], order[min(1, len(order) - 1)]
            self.first.append(a)
            rows.add((int(terms[a]), int(terms[b]), b - a, a, len(terms)))
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.second, self.apart, self.offset, self.length = (
            np.ascontiguousarray(table[:, k]) for k in range(1, 5))
        self.start = np.searchsorted(table[:, 0], np.arange(len(count) + 1))

    def covered(self, ids: np.ndarray) -> np.ndarray:
        """Positions of windows whose two anchors both stand where they should."""
        n = len(ids)
        many = np.where(ids >= 0, self.start[ids + 1] - self.start[ids], 0)
        at = np.flatnonzero(many)
        if not len(at):
            return at
        each = many[at]
        pair = np.repeat(self.start[ids[at]] - np.cumsum(each) + each, each) + np.arange(each.sum())
        at = np.repeat(at, each)
        begin, other = at - self.offset[pair], at + self.apart[pair]
        ok = (begin >= 0) & (begin + self.length[pair] <= n)
        ok[ok] = ids[other[ok]] == self.second[pair[ok]]
        edge = np.bincount(begin[ok], minlength=n + 1).astype(np.int64)
        edge -= np.bincount(begin[ok] + self.length[pair[ok]], minlength=n + 1)
        return np.flatnonzero(np.cumsum(edge[:n]) > 0)


def _postings(vocabulary: dict[bytes, int], anchors: Anchors | None):
    schema = pa.schema([
        ("doc_id", pa.int64()), ("text_key", pa.binary()), ("n_words", pa.int64()),
        ("terms", pa.list_(pa.int32())), ("positions", pa.list_(pa.int32()))])

    def run(batches):
        ids = _term_ids(vocabulary)
        for batch in in_parts(batches, 1):
            keys, words, terms, places = [], [], [], []
            for data in utf8(batch.column(1)):
                found = ids(data)
                at = anchors.covered(found) if anchors else np.arange(len(found))
                at = at[found[at] >= 0].astype(np.int32)
                keys.append(xxhash.xxh128_digest(data or b"")), words.append(len(found))
                terms.append(found[at]), places.append(at)
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(keys, pa.binary()), pa.array(words, pa.int64()),
                pa.array(terms, pa.list_(pa.int32())), pa.array(places, pa.list_(pa.int32()))],
                schema=schema)

    return run


def _index(docs: DataFrame, vocabulary, anchors=None) -> tuple[DataFrame, DataFrame]:
    """``(doc_id, text_key, n_words)`` per row, and the stored postings of distinct texts."""
    found = materialize(docs.mapInArrow(
        _postings(vocabulary, anchors), "doc_id long, text_key binary, n_words long, "
        "terms array<int>, positions array<int>"), "forward")
    once = found.where(F.size("terms") > 0).select("text_key", "terms", "positions").dropDuplicates(
        ["text_key"])
    postings = once.select(
        "text_key", F.explode(F.arrays_zip("terms", "positions")).alias("p")).select(
            F.col("p.terms").alias("term"), "text_key", F.col("p.positions").alias("pos"))
    return found.select("doc_id", "text_key", "n_words"), materialize(postings, "postings")


def build_postings(docs: DataFrame, terms: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """Rows of ``docs (doc_id, text)``, every posting of ``terms``, and the numbered terms."""
    words = sorted({_term(w) for t in terms for w in letter_words(t.encode())})
    rows, postings = _index(_columns(docs, "doc_id"), {w: k for k, w in enumerate(words)})
    return rows, postings, [w.decode(errors="replace") for w in words]


def _columns(df: DataFrame, key: str) -> DataFrame:
    kind = "long" if key == "doc_id" else "string"
    return df.select(F.col(key).cast(kind).alias(key), F.col("text"))


def phrase_matches(postings: DataFrame, phrases: DataFrame) -> DataFrame:
    """``(phrase, text_key, start, length)`` of every exact occurrence.

    ``phrases (phrase, term, offset, first, length)`` has a row per position of a phrase;
    ``first`` marks its rarest term. It is small enough to broadcast (see ``SLICE_WINDOWS``).
    """
    starts = postings.join(F.broadcast(phrases.where("first")), "term").select(
        "phrase", "text_key", (F.col("pos") - F.col("offset")).alias("start"))
    rest = phrases.select("phrase", "term", "offset", "length")
    wanted = starts.where("start >= 0").join(F.broadcast(rest), "phrase").select(
        "phrase", "text_key", "start", "length", "term",
        (F.col("start") + F.col("offset")).alias("pos"))
    return wanted.join(postings, ["text_key", "term", "pos"]).groupBy(
        "phrase", "text_key", "start", "length").agg(F.count("*").alias("n")).where(
            "n = length").drop("n")


def proximity_matches(postings: DataFrame, phrases: DataFrame, slop: int) -> DataFrame:
    """``(phrase, text_key, near)``: positions of the rarest term around which every term of the
    phrase stands, in any order, at most ``length - 1 + slop`` words away."""
    near = postings.join(F.broadcast(phrases.where("first")), "term").select(
        "phrase", "text_key", "length", F.col("pos").alias("near"))
    rest = phrases.select("phrase", "term").distinct()
    need = phrases.groupBy("phrase").agg(F.count_distinct("term").alias("need"))
    wanted = near.join(F.broadcast(rest), "phrase")
    close = F.abs(F.col("pos") - F.col("near")) <= F.col("length") - 1 + slop
    return wanted.join(postings, ["text_key", "term"]).where(close).groupBy(
        "phrase", "text_key", "near").agg(F.count_distinct("term").alias("n")).join(
            F.broadcast(need), "phrase").where("n = need").select("phrase", "text_key", "near")


def _phrases(spark, windows: list[np.ndarray], first: list[int]) -> DataFrame:
    length = np.array([len(w) for w in windows], np.int32)
    number = np.repeat(np.arange(len(windows), dtype=np.int32), length)
    offset = np.concatenate([np.arange(n, dtype=np.int32) for n in length])
    table = pa.table({
        "phrase": number, "term": np.concatenate(windows).astype(np.int32), "offset": offset,
        "first": offset == np.array(first, np.int32)[number], "length": length[number]})
    return materialize(spark.createDataFrame(table), "phrases")


def phrase_table(spark, phrases: list[str], terms: list[str], postings: DataFrame) -> DataFrame:
    """Rows for ``phrase_matches``: the numbered terms of each phrase, its rarest marked."""
    number = {w: k for k, w in enumerate(terms)}
    count = np.zeros(len(terms), np.int64)
    for r in postings.groupBy("term").count().collect():  # a row per term of the phrases
        count[r["term"]] = r["count"]
    windows = [np.array([number[w.decode(errors="replace")] for w in map(
        _term, letter_words(p.encode()))], np.int64) for p in phrases]
    return _phrases(spark, windows, Anchors(windows, count).first)


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW,
                  slice_windows: int = SLICE_WINDOWS) -> DataFrame:
    """One row per row of ``docs (doc_id, text)``, against ``items (item_id, text)``.

    ``n_words``, ``n_hit`` (words inside an occurrence of an item's window), ``n_items`` (items
    with an occurring window), ``items_sha256`` (of their ids, sorted as text, comma-joined;
    of the empty text if there are none) and ``contaminated`` (n_hit > 0).

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased. An item
    of fewer than ``window`` words is one window; an item without words is none. Null texts
    have no words. Items that share an id count as one; items without an id hit words but are
    not listed. Repeated rows get equal rows. Other columns are not looked at.
    """
    spark = docs.sparkSession
    docs = _columns(docs, "doc_id")
    cut = materialize(_columns(items, "item_id").mapInArrow(
        _windows(window), "item_id string, window_key binary, terms array<binary>"), "windows")
    distinct = materialize(
        cut.groupBy("window_key").agg(F.first("terms").alias("terms")), "windows")
    slices = max(1, -(-distinct.count() // slice_windows))
    part = F.pmod(F.xxhash64("window_key"), F.lit(slices))

    rows, hits, listed = None, None, None
    for k in range(slices):
        # At most a slice of windows comes to the driver.
        chosen = distinct.where(part == k).orderBy("window_key").collect()
        words = sorted({w for r in chosen for w in r["terms"]})
        vocabulary = {bytes(w): n for n, w in enumerate(words)}
        windows = [np.array([vocabulary[bytes(w)] for w in r["terms"]], np.int64) for r in chosen]
        count = np.zeros(len(vocabulary), np.int64)
        if windows:
            for r in docs.select("text").mapInArrow(_counts(vocabulary), "term int, n long").groupBy(
                    "term").agg(F.sum("n").alias("n")).collect():
                count[r["term"]] = r["n"]
        anchors = Anchors(windows, count)
        found, postings = _index(docs, vocabulary, anchors)
        rows = rows if rows is not None else found
        if not windows:
            break
        names = materialize(spark.createDataFrame(pa.table({
            "phrase": pa.array(range(len(chosen)), pa.int32()),
            "window_key": pa.array([bytes(r["window_key"]) for r in chosen], pa.binary())})), "names")
        at = materialize(
            phrase_matches(postings, _phrases(spark, windows, anchors.first)), "matches")
        words_hit = at.select("text_key", F.explode(F.sequence(
            "start", F.col("start") + F.col("length") - 1)).alias("pos")).distinct()
        ids = at.select("text_key", "phrase").distinct().join(F.broadcast(names), "phrase").join(
            F.broadcast(cut.select("window_key", "item_id").distinct())
            if slices == 1 else cut.select("window_key", "item_id").distinct(), "window_key"
        ).select("text_key", "item_id").distinct()
        hits = words_hit if hits is None else hits.unionByName(words_hit).distinct()
        listed = ids if listed is None else listed.unionByName(ids).distinct()

    empty = F.sha2(F.lit("").cast("binary"), 256)
    if hits is None:
        return rows.select("doc_id", "n_words", F.lit(0).cast("long").alias("n_hit"),
                           F.lit(0).cast("long").alias("n_items"), empty.alias("items_sha256"),
                           F.lit(False).alias("contaminated"))
    ids = F.array_sort(F.collect_list("item_id"))  # nulls are left out
    found = hits.groupBy("text_key").agg(F.count("*").alias("n_hit")).join(
        listed.groupBy("text_key").agg(
            F.count("item_id").alias("n_items"),
            F.sha2(F.concat_ws(",", ids).cast("binary"), 256).alias("items_sha256")), "text_key")
    found = materialize(found, "found")
    return rows.join(found, "text_key", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).alias("n_items"),
        F.coalesce("items_sha256", empty).alias("items_sha256"),
        F.col("n_hit").isNotNull().alias("contaminated"))
