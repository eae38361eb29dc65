"""Near copies of documents: one-permutation MinHash, banded buckets, star-shaped candidates.

1. Every text becomes its set of word shingles (64-bit hashes). Equal sets form one class with
   the smallest doc_id as its representative; only representatives go on.
2. One hash gives all 128 minima: its top bits choose the bin, the rest is compared. An empty
   bin borrows from the first filled bin of its own random order (optimal densification).
3. Four minima make the key of one of 32 buckets. At a Jaccard similarity of 0.8 two documents
   miss each other in all of them with probability 5e-8.
4. A bucket links each member to three centres (smallest, largest and a hashed choice), so a
   bucket of m members makes at most 3m candidates. A 128-bit sketch drops chance meetings.
5. Candidates are confirmed on the full sets: first one per document, then every candidate that
   still lies between different components. The rest could not change the components.
6. Two members of a bucket that are no centres may still be partners. Those of different
   components are compared block by block: first their counts and sketches, whose links group
   them, then the full sets of each group. So each pair that meets in a bucket is decided.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.blocks import (
    BLOCK, BLOCK_SETS, BLOCK_SHINGLES, alike, compare, linked, meetings)
from gaugeframe.llm.components import components
from gaugeframe.llm.rows import sized
from gaugeframe.llm.text import in_parts, mix, shingles, shingles_of, space_words, utf8
from gaugeframe.sources.scratch import materialize

BINS, BAND_ROWS = 128, 4
# Text that is hashed at once inside a task; a longer document is a part of its own.
PART_BYTES = 1 << 20
# Copies, as (id, set) pairs, that are sent to every executor (about 64 MB).
BROADCAST_COPIES = 1_000_000
# Of 128 sketch bits; two sets at 0.8 differ in 13 (standard deviation 3.4), strangers in 61.
MAX_BITS_APART = 34

_rng = np.random.default_rng(20240229)
_ORDER = np.stack([_rng.permutation(BINS) for _ in range(BINS)])
_SALT = _rng.integers(0, 2**63, BINS, dtype=np.uint64)


def one_permutation(codes: np.ndarray, owner: np.ndarray, count: int) -> np.ndarray:
    """The 128 densified minima of ``count`` non-empty sets, a row each.

    ``codes`` holds the hashes of all sets, sorted within each; ``owner`` their set, ascending.
    """
    place = (codes >> np.uint64(57)).astype(np.int64)
    first = np.ones(len(codes), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1])
    minima, filled = np.zeros((count, BINS), np.uint64), np.zeros((count, BINS), bool)
    minima[owner[first], place[first]] = codes[first]
    filled[owner[first], place[first]] = True
    row, empty = np.nonzero(~filled)
    for step in range(BINS):
        if not len(row):
            break
        donor = _ORDER[empty, step]
        found = filled[row, donor]
        minima[row[found], empty[found]] = minima[row[found], donor[found]]
        row, empty = row[~found], empty[~found]
    return minima


def band_keys(minima: np.ndarray, n_bands: int, rows: int) -> np.ndarray:
    """One bucket key per set and band."""
    part = minima[:, : n_bands * rows].reshape(-1, n_bands, rows)
    keys = np.broadcast_to(np.arange(n_bands, dtype=np.uint64), part.shape[:2])
    for k in range(rows):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + part[:, :, k])
    return keys.view(np.int64)


def bit_sketch(minima: np.ndarray) -> np.ndarray:
    """One bit per bin, as two longs per set."""
    bits = (mix(minima ^ _SALT) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1).view(np.int64)


def bands_for(percent: int, recall: float, rows: int = BAND_ROWS) -> int:
    """The fewest bands that bring two sets at the threshold together with this probability."""
    miss = 1 - (percent / 100) ** rows
    return min(BINS // rows, math.ceil(math.log(1 - recall) / math.log(miss)))


def _parts(texts: list[bytes | None]):
    """Slices of a batch of about ``PART_BYTES`` of text."""
    start = held = 0
    for i, data in enumerate(texts):
        held += len(data or b"")
        if held >= PART_BYTES:
            yield texts[start : i + 1]
            start, held = i + 1, 0
    if start < len(texts):
        yield texts[start:]


_SIGNED = ("doc_id long, n_shingles long, set_key binary, bands array<bigint>, s1 long, s2 long")


def _signatures(size: int, n_bands: int, rows: int):
    def part(texts: list[bytes | None]) -> list[pa.Array]:
        codes, owner, counts = shingles_of([space_words(t) for t in texts], size)
        full = np.flatnonzero(counts)
        minima = one_permutation(codes, np.repeat(np.arange(len(full)), counts[full]), len(full))
        ends = np.cumsum(counts)
        keys = [xxhash.xxh128_digest(codes[e - n : e].tobytes()) if n else None
                for e, n in zip(ends, counts)]
        at = np.full(len(texts), -1)
        at[full] = np.arange(len(full))
        at = pa.array(at, mask=at < 0)
        bands = pa.ListArray.from_arrays(
            pa.array(np.arange(len(full) + 1, dtype=np.int32) * n_bands),
            pa.array(band_keys(minima, n_bands, rows).ravel()))
        sketch = bit_sketch(minima)
        return [pa.array(counts, pa.int64()), pa.array(keys, pa.binary()), bands.take(at),
                pa.array(sketch[:, 0]).take(at), pa.array(sketch[:, 1]).take(at)]

    def run(batches):
        names = ["doc_id", "n_shingles", "set_key", "bands", "s1", "s2"]
        for batch in in_parts(batches, 1):
            start = 0
            for texts in _parts(utf8(batch.column(1))):
                ids = batch.column(0).slice(start, len(texts))
                start += len(texts)
                yield pa.RecordBatch.from_arrays([ids, *part(texts)], names=names)

    return run


def _sets(size: int):
    schema = pa.schema([("id", pa.int64()), ("codes", pa.list_(pa.int64()))])

    def run(batches):
        for batch in in_parts(batches, 1):
            codes = [shingles(space_words(data), size).view(np.int64)
                     for data in utf8(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(codes, pa.list_(pa.int64()))], schema=schema)

    return run


def _buckets(reps: DataFrame) -> DataFrame:
    """Buckets of several documents, with their centres."""
    band = reps.select("id", F.explode("bands").alias("key"))
    # The key is a hash: the smallest of id XOR key is a hashed choice that one long can hold.
    other = F.min(F.col("id").bitwiseXOR(F.col("key"))).bitwiseXOR(F.col("key"))
    return materialize(
        band.groupBy("key").agg(
            F.min("id").alias("low"), F.max("id").alias("high"), other.alias("other"),
            F.count("*").alias("members"))
        .where("low < high"), "buckets")


def _candidates(reps: DataFrame, buckets: DataFrame) -> DataFrame:
    """Distinct ``(a, b)`` with a > b, a bucket's member and centre that have similar sketches."""
    band = reps.select("id", F.explode("bands").alias("key"))
    buckets = buckets.drop("members")
    met = band.join(buckets, "key").select(
        "id", F.explode(F.array("low", "high", "other")).alias("centre"))
    pairs = materialize(
        met.where("id <> centre").select(
            F.greatest("id", "centre").alias("a"), F.least("id", "centre").alias("b")).distinct(),
        "met")
    sketch = reps.select("id", "n_shingles", "s1", "s2")
    a, b = (sketch.toDF(x, f"n_{x}", f"s1_{x}", f"s2_{x}") for x in "ab")
    apart = F.bit_count(F.col("s1_a").bitwiseXOR(F.col("s1_b"))) + F.bit_count(
        F.col("s2_a").bitwiseXOR(F.col("s2_b")))
    return pairs.join(a, "a").join(b, "b").where(apart <= MAX_BITS_APART)


def _open_groups(reps: DataFrame, buckets: DataFrame, found: DataFrame,
                 percent: int) -> DataFrame | None:
    """``(spot, id, root)`` of members that could still be linked, by groups of similar ones.

    Centres were compared with all of their bucket, so at least two others must be left.
    """
    wide = materialize(buckets.where("members > 3").drop("members"), "wide")
    band = reps.select("id", F.explode("bands").alias("key"))
    rest = band.join(wide, "key").where("id <> low AND id <> high AND id <> other")
    root = found.select("id", F.col("component").alias("root"))
    rest = materialize(rest.select("key", "id").join(root, "id", "left").select(
        F.col("key").alias("spot"), "id", F.coalesce("root", "id").alias("root"),
        F.lit(1.0 / BLOCK).alias("load")), "rest")
    met = meetings(rest)
    if met is None:
        return None
    sketch = reps.select("id", F.col("n_shingles").alias("n"), "s1", "s2")
    near = materialize(compare(met.join(sketch, "id"), alike(percent, MAX_BITS_APART),
                               ["n", "s1", "s2"]), "near")
    if not near.head(1):
        return None
    groups = materialize(components(near), "groups")
    return materialize(groups.select(F.col("component").alias("spot"), "id").join(
        root, "id", "left").withColumn("root", F.coalesce("root", "id")), "open")


def _late_links(docs: DataFrame, groups: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Edges of the links between different roots of a group, decided on the full sets."""
    ids = groups.select(F.col("id").alias("open"))
    texts = docs.join(sized(ids), docs["doc_id"] == F.col("open"), "left_semi")
    sets = materialize(texts.mapInArrow(_sets(size), "id long, codes array<bigint>")
                       .where(F.size("codes") > 0), "open-sets")
    load = F.greatest(F.size("codes") / BLOCK_SHINGLES, F.lit(1.0 / BLOCK_SETS))
    members = materialize(groups.join(sets.select("id", load.alias("load")), "id"), "members")
    met = meetings(members)
    if met is None:
        return None
    # A doc_id that repeats is compared with each of its sets.
    return materialize(
        compare(met.drop("load").distinct().join(sets, "id"), linked(percent), ["codes"]), "links")


def _representatives(filled: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows of ``filled`` that carry the id of their class, found without moving their bands
    unless there are very many copies."""
    several = classes.where("id < last").select(F.col("set_key").alias("key"), "id")
    copies = materialize(
        filled.select("doc_id", "set_key").join(several, F.col("set_key") == F.col("key"))
        # Not made distinct here: that would keep a set with very many copies in one task.
        .where("doc_id <> id").select(F.col("doc_id").alias("copy"), "key"), "copies")
    few = copies.count() <= BROADCAST_COPIES
    reps = filled.join(
        F.broadcast(copies) if few else copies,
        (filled["doc_id"] == F.col("copy")) & (filled["set_key"] == F.col("key")), "left_anti")
    reps = reps.select(F.col("doc_id").alias("id"), "n_shingles", "bands", "s1", "s2")
    return reps if few else materialize(reps, "representatives")


def near_copies(
    docs: DataFrame, size: int = 5, percent: int = 80, n_bands: int = BINS // BAND_ROWS,
    band_rows: int = BAND_ROWS,
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for each row of ``docs (doc_id, text)``.

    Documents are linked when 100 * intersection >= percent * union of their sets of ``size``
    consecutive words (runs without ASCII white space, A-Z lower-cased). A text of fewer words
    is one shingle; a null or blank text has none and is linked with nothing.

    ``component_id`` is the smallest doc_id that links lead to. Rows that share a doc_id count
    as one document. A row without an id belongs to the class of equal texts that has one and
    is then not kept; otherwise its component is null and it is kept. An empty table gives an
    empty result. Other columns of ``docs`` are not looked at. Fewer bands than all trade recall
    for work (``bands_for``).
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    signed = materialize(docs.mapInArrow(_signatures(size, n_bands, band_rows), _SIGNED),
                         "signatures")
    filled = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = materialize(
        filled.groupBy("set_key").agg(F.min("doc_id").alias("id"), F.max("doc_id").alias("last")),
        "classes")
    reps = _representatives(filled, classes)

    fits = F.lit(100) * F.least("n_a", "n_b") >= F.lit(percent) * F.greatest("n_a", "n_b")
    buckets = _buckets(reps)
    pairs = materialize(_candidates(reps, buckets).where(fits).select("a", "b").distinct(), "pairs")
    wanted = materialize(
        pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "wanted")
    texts = docs.join(sized(wanted), docs["doc_id"] == wanted["id"], "left_semi")
    sets = materialize(texts.mapInArrow(_sets(size), "id long, codes array<bigint>")
                       .where(F.size("codes") > 0), "sets")

    def confirmed(some: DataFrame) -> DataFrame:
        both = some.join(sets.toDF("a", "codes_a"), "a").join(sets.toDF("b", "codes_b"), "b")
        common = F.size(F.array_intersect("codes_a", "codes_b"))
        union = F.size("codes_a") + F.size("codes_b") - common
        return both.where(F.lit(100) * common >= F.lit(percent) * union).select("a", "b")

    first = materialize(confirmed(pairs.groupBy("a").agg(F.min("b").alias("b"))), "links")
    found = materialize(components(first), "components")
    root_a = found.select(F.col("id").alias("a"), F.col("component").alias("root_a"))
    root_b = found.select(F.col("id").alias("b"), F.col("component").alias("root_b"))
    open_pairs = pairs.join(root_a, "a", "left").join(root_b, "b", "left").where(
        F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")
    second = materialize(confirmed(open_pairs), "links")
    links = first.unionByName(second)
    if second.head(1):
        found = materialize(components(links), "components")
    groups = _open_groups(reps, buckets, found, percent)
    third = _late_links(docs, groups, size, percent) if groups is not None else None
    if third is not None and third.head(1):
        found = materialize(components(links.unionByName(third)), "components")

    # Classes that stand for several documents or were linked; all others are their own.
    moved = materialize(
        classes.select("set_key", "id", "last").join(found, "id", "left").select(
            "set_key", F.coalesce("component", "id").alias("component"), "id", "last")
        .where("id <> last OR component <> id").select("set_key", "component"), "moved")
    lone = signed.where("doc_id IS NULL AND set_key IS NOT NULL").select("set_key").distinct()
    alone = classes.select("set_key", F.col("id").alias("component")).where("id = last").join(
        lone, "set_key").join(moved.select("set_key"), "set_key", "left_anti")
    out = signed.select("doc_id", "n_shingles", "set_key").join(
        materialize(moved.unionByName(alone), "moved"), "set_key", "left")
    component = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"))
