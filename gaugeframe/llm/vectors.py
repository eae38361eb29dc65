"""Near copies among vectors of one label: product quantisation with exact reranking.

1. Equal vectors of a label form one class. Class vectors are scaled to length 1, so a cosine of
   at least c means a distance of at most r = sqrt(2 - 2c).
2. Coarse centroids split the space into inverted lists; a vector's residual is coded by the
   nearest of up to 256 codewords in each of 8 subspaces. Both are fitted on a bounded sample;
   every vector is coded, with the distance between it and its code.
3. A vector searches each list that could hold one within r: the plane half way between its own
   centroid and that of the list is at most r away. With its distances to all codewords in a
   table, its distance to a coded vector is a sum of 8 entries; a vector can only be within r
   if that sum is at most r plus its coding error. Neither step loses a pair.
4. What remains is compared exactly, in double precision.

A list is searched in blocks of vectors against blocks of vectors. A block returns the number
of links of each vector and one edge per vector to the component it has in the block, so m near
copies make about m rows, not m * m.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.llm.components import components
from gaugeframe.sources.scratch import materialize

COSINE = 0.98
# The sample that centroids and codewords are fitted on: at most so many vectors and bytes.
SAMPLE, SAMPLE_BYTES = 20_000, 32 * 1024 * 1024
LIST_SIZE, BLOCK, SUBSPACES, CODEWORDS = 4_096, 1_024, 8, 256
SLACK = 1e-7


def _parsed(batches):
    """Valid vectors as double bytes with a digest; others as null."""
    for batch in batches:
        data, keys = [], []
        for row in batch.column(2):
            values = row.values.to_numpy(zero_copy_only=False) if row.is_valid else np.empty(0)
            values = np.ascontiguousarray(values, np.float64) + 0.0  # -0.0 becomes 0.0
            good = len(values) and np.isfinite(values).all() and values.any()
            norm = np.linalg.norm(values) if good else 0.0
            good = good and 0 < norm < math.inf
            data.append(values.tobytes() if good else None)
            keys.append(xxhash.xxh128_digest(data[-1]) if good else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(keys, pa.binary()),
             pa.array(data, pa.binary())], names=["vec_id", "label", "vec_key", "vector"])


def _kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        centres[count > 0] = total[count > 0] / count[count > 0, None]
    return centres


def _squares(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([_squares(part, centres).argmin(1) for part in np.array_split(
        x, max(1, len(x) // 4096))]) if len(x) else np.empty(0, np.int64)


@dataclass(frozen=True)
class Quantiser:
    """Coarse centroids, and codewords per slice of the dimensions."""

    centres: np.ndarray
    slices: list[slice]
    words: list[np.ndarray]

    @classmethod
    def fit(cls, x: np.ndarray, lists: int) -> Quantiser:
        centres = _kmeans(x, lists)
        rest = x - centres[_nearest(x, centres)]
        edges = np.linspace(0, x.shape[1], min(SUBSPACES, x.shape[1]) + 1).astype(int)
        slices = [slice(a, b) for a, b in zip(edges, edges[1:])]
        return cls(centres, slices, [_kmeans(rest[:, s], min(CODEWORDS, max(1, len(x) // 8)))
                                     for s in slices])

    def code(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, codes and coding error of each row."""
        near = _nearest(x, self.centres)
        rest = x - self.centres[near]
        codes = np.stack([_nearest(np.ascontiguousarray(rest[:, s]), w)
                          for s, w in zip(self.slices, self.words)], 1).astype(np.uint8)
        back = np.concatenate([w[codes[:, k]] for k, w in enumerate(self.words)], 1)
        return near, codes, np.linalg.norm(rest - back, axis=1)

    def probes(self, x: np.ndarray, reach: float) -> np.ndarray:
        """Which lists could hold a vector within ``reach`` of each row."""
        far = _squares(x, self.centres)
        near = far.argmin(1)
        apart = np.sqrt(np.maximum(0, _squares(self.centres, self.centres)))
        return far - far[np.arange(len(x)), near][:, None] <= 2 * reach * apart[near] + SLACK

    def distances(self, x: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Distances from rows of ``x`` to coded vectors of one list, by table look-up."""
        rest = x - self.centres[at]
        total = np.zeros((len(x), len(codes)))
        for k, (s, w) in enumerate(zip(self.slices, self.words)):
            total += _squares(rest[:, s], w)[:, codes[:, k]]
        return np.sqrt(np.maximum(0, total))


def _padded(data, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of any length as rows of one width, and scaled to length 1."""
    raw = np.zeros((len(data), width))
    for k, d in enumerate(data):
        v = np.frombuffer(d, np.float64)
        raw[k, : len(v)] = v
    # Scaled by the largest part first, so that squares do not overflow.
    unit = raw / np.abs(raw).max(1, keepdims=True)
    return raw, unit / np.linalg.norm(unit, axis=1, keepdims=True)


def _placed(q: Quantiser, width: int, reach: float):
    """Per class one row for its own list and one per list to search."""

    def run(batches):
        for batch in batches:
            data = batch.column("vector").to_pylist()
            if not data:
                continue
            _, unit = _padded(data, width)
            near, codes, error = q.code(unit)
            row, to_list = np.nonzero(q.probes(unit, reach))
            n = len(data)
            take = np.concatenate([np.arange(n), row])
            own = np.arange(len(take)) < n
            yield pa.RecordBatch.from_arrays([
                *[batch.column(c).take(pa.array(take)) for c in ("label", "dim", "id", "n", "vector")],
                pa.array(np.concatenate([near, to_list]), pa.int64()), pa.array(own),
                pa.array([codes[k].tobytes() if o else None for k, o in zip(take, own)], pa.binary()),
                pa.array(error[take])],
                names=["label", "dim", "id", "n", "vector", "list", "own", "codes", "error"])

    return run


def _linked(q: Quantiser, width: int, cosine: float, reach: float):
    """Links between the searching and the listed vectors of one block pair."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        own = part["own"].to_numpy()
        listed, asking = part[own], part[~own]
        empty = pd.DataFrame({"id": [], "links": [], "root": []}).astype("int64")
        if not len(listed) or not len(asking):
            return empty
        at = int(part["list"].iloc[0])
        raw_q, unit_q = _padded(asking["vector"], width)
        raw_i, _ = _padded(listed["vector"], width)
        codes = np.frombuffer(b"".join(listed["codes"]), np.uint8).reshape(len(listed), -1)
        ids_q, ids_i = asking["id"].to_numpy(), listed["id"].to_numpy()
        near = q.distances(unit_q, at, codes) <= reach + listed["error"].to_numpy() + SLACK
        near &= ids_q[:, None] != ids_i
        scale = np.abs(raw_q).max(1, keepdims=True), np.abs(raw_i).max(1, keepdims=True)
        raw_q, raw_i = raw_q / scale[0], raw_i / scale[1]
        norm_q, norm_i = np.linalg.norm(raw_q, axis=1), np.linalg.norm(raw_i, axis=1)
        a, b = np.nonzero(near)
        link = np.zeros(near.shape, bool)
        for k in range(0, len(a), 20_000):
            x, y = a[k : k + 20_000], b[k : k + 20_000]
            dot = np.einsum("ij,ij->i", raw_q[x], raw_i[y])
            link[x, y] = dot / (norm_q[x] * norm_i[y]) >= cosine
        rows, columns = link.any(1), link.any(0)
        if not rows.any():
            return empty
        link, ids_q, ids_i = link[rows][:, columns], ids_q[rows], ids_i[columns]
        links = link @ listed["n"].to_numpy()[columns]
        # The smallest id that links of this block lead to.
        root_q, big = ids_q.copy(), np.iinfo(np.int64).max
        root_i = np.minimum(ids_i, np.where(link, root_q[:, None], big).min(0))
        while True:
            new = np.minimum(root_q, np.where(link, root_i, big).min(1))
            root_i = np.minimum(root_i, np.where(link, new[:, None], big).min(0))
            if (new == root_q).all():
                break
            root_q = new
        return pd.DataFrame({
            "id": np.concatenate([ids_q, ids_i]),
            "links": np.concatenate([links, np.zeros(len(ids_i), np.int64)]),
            "root": np.concatenate([root_q, root_i])})

    return run


def link_vectors(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``vectors (vec_id, embedding, label)``.

    Vectors of one label and length are linked from ``cosine`` on. A vector that is null, empty,
    zero, or holds a null or non-finite number, and one without label or id, is linked with
    nothing. Repeated rows count as vectors of their own. ``component_id`` is the smallest vec_id
    that links lead to; a row without an id has none and is kept.
    """
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("embedding"))
    rows = materialize(rows.mapInArrow(
        _parsed, "vec_id long, label string, vec_key binary, vector binary"), "vectors")
    good = rows.where("vec_key IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL")
    classes = materialize(good.groupBy("label", "vec_key").agg(
        F.min("vec_id").alias("id"), F.count("*").alias("n"), F.first("vector").alias("vector"))
        .withColumn("dim", F.length("vector") / 8), "classes")
    total, width = classes.agg(F.count("*"), F.max("dim")).head()
    out = rows.select("vec_id", "label", "vec_key")
    if not total:
        return out.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                          F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    width = int(width)
    sample = max(1, min(SAMPLE, SAMPLE_BYTES // (8 * width)))
    draw = F.pmod(F.xxhash64("vec_key", F.lit(3)), F.lit(1 << 30)) / float(1 << 30)
    drawn = classes.where(draw < sample / total).orderBy("vec_key").select("vector").limit(
        2 * sample).collect() or classes.select("vector").limit(1).collect()
    _, x = _padded([r["vector"] for r in drawn], width)
    q = Quantiser.fit(x, max(1, min(total // LIST_SIZE, len(x) // 40)))
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))

    placed = materialize(classes.select("label", "dim", "id", "n", "vector").mapInArrow(
        _placed(q, width, reach), "label string, dim double, id long, n long, vector binary, "
        "list long, own boolean, codes binary, error double"), "placed")
    place = ["label", "dim", "list"]
    blocks = lambda c: F.ceil(F.sum(c.cast("long")) / BLOCK)
    sizes = materialize(placed.groupBy(*place).agg(
        blocks(F.col("own")).alias("own_blocks"), blocks(~F.col("own")).alias("ask_blocks")), "lists")
    mine = F.when(F.col("own"), F.col("own_blocks")).otherwise(F.col("ask_blocks"))
    theirs = F.when(F.col("own"), F.col("ask_blocks")).otherwise(F.col("own_blocks"))
    spread = placed.join(sizes, place).where(theirs > 0).withColumn(
        "block", F.pmod(F.xxhash64("id"), mine)).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), theirs - 1)))
    pair = spread.withColumn("own_block", F.when(F.col("own"), F.col("block")).otherwise(F.col("other")))
    pair = pair.withColumn("ask_block", F.when(F.col("own"), F.col("other")).otherwise(F.col("block")))
    found = materialize(pair.select(
        *place, "own_block", "ask_block", "id", "n", "vector", "own", "codes", "error").groupBy(
            *place, "own_block", "ask_block").applyInPandas(
                _linked(q, width, cosine, reach), "id long, links long, root long"), "found")
    roots = components(found.where("id <> root"), "id", "root")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = materialize(classes.select("label", "vec_key", "id", "n").join(links, "id", "left").join(
        roots, "id", "left").where("n > 1 OR links > 0").select(
            "label", "vec_key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "id").alias("component")), "known")
    own = F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "vec_id"))
    return out.join(known, ["label", "vec_key"], "left").select(
        "vec_id", F.when(F.col("vec_id").isNotNull(), F.coalesce("n_links", F.lit(0))).otherwise(
            F.lit(0)).alias("n_links"), own.alias("component_id"),
        F.coalesce(F.col("vec_id") == own, F.lit(True)).alias("kept"))
