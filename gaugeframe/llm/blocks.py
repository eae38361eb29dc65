"""All pairs of the members of a group that are not linked yet, block by block.

Members of one group and one root need no comparison with each other. A root that fills more
than one block has blocks of its own; the other members of its group share blocks. Two blocks
meet unless both belong to one root, and each meeting is a part of one task, whose rows are
bounded. A task returns edges to the components inside it, so m members make about m rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.sources.scratch import materialize

# Members without their sets that are compared at once with as many others.
BLOCK = 1_024
# Shingles, and sets, of a block of sets (8 MB).
BLOCK_SHINGLES, BLOCK_SETS = 1 << 20, 1_024
EDGES = "a long, b long"


def meetings(members: DataFrame) -> DataFrame | None:
    """``members (spot, id, root, load, ...)``, stored, copied to every meeting of two blocks, with
    ``x, y`` (the blocks that meet), ``block`` (its own) and ``slot`` (the task); None if no spot
    holds two roots. ``load`` is the part of a block that a member fills."""
    roots = materialize(members.groupBy("spot", "root").agg(F.sum("load").alias("load")), "loads")
    spots = materialize(roots.groupBy("spot").agg(
        F.count("*").alias("roots"),
        F.sum(F.when(F.col("load") <= 1, F.col("load"))).alias("load")).where("roots > 1"), "spots")
    big = roots.where("load > 1").join(spots.select("spot"), "spot").select(
        "spot", F.col("root").alias("owner"), "load")
    pool = spots.where("load IS NOT NULL").select(
        "spot", F.lit(None).cast("long").alias("owner"), "load")
    owners = materialize(
        big.unionByName(pool).withColumn("blocks", F.ceil("load")), "owners")
    block = lambda k: F.xxhash64("owner", k).alias("block")
    blocks = owners.withColumn(
        "k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
            "spot", "owner", block(F.col("k")), (F.col("load") / F.col("blocks")).alias("part"))
    one, two = (blocks.toDF("spot", f"owner_{c}", c, f"part_{c}") for c in "xy")
    pairs = materialize(
        one.join(two, "spot").where("x <= y AND (owner_x IS NULL OR NOT owner_x <=> owner_y)")
        .select("spot", "x", "y", (F.col("part_x") + F.col("part_y")).alias("part")), "meetings")
    total = pairs.agg(F.sum("part")).head()[0]
    if not total:
        return None
    slots = max(1, int(total / 2) + 1)
    pairs = pairs.select(
        "spot", "x", "y", F.pmod(F.xxhash64("spot", "x", "y"), F.lit(slots)).alias("slot"),
        F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    own = owners.where("owner IS NOT NULL").select(
        F.col("spot"), F.col("owner").alias("root"), F.col("owner"), F.col("blocks").alias("own"))
    shared = owners.where("owner IS NULL").select("spot", F.col("blocks").alias("shared"))
    placed = members.join(shared, "spot", "left").join(own, ["spot", "root"], "left").where(
        "own IS NOT NULL OR shared IS NOT NULL")
    placed = placed.withColumn(
        "block", block(F.pmod(F.xxhash64("id"), F.coalesce("own", "shared")))).drop(
            "owner", "own", "shared")
    return placed.join(pairs, ["spot", "block"])


def compare(met: DataFrame, edges: Callable[..., Iterator[tuple[np.ndarray, np.ndarray]]],
            columns: list[str]) -> DataFrame:
    """``(a, b)`` from ``edges(part, one, two)`` of every meeting: ``one`` and ``two`` are the
    places in ``part`` of the members of either block."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["spot", "x", "y"], ignore_index=True)
        key = part[["spot", "x", "y"]].to_numpy()
        start = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(1)))
        block = part["block"].to_numpy()
        found = []
        for a, b in zip(start, [*start[1:], len(part)]):
            place = np.arange(a, b)
            one, two = place[block[a:b] == key[a, 1]], place[block[a:b] == key[a, 2]]
            if len(one) and len(two):
                found.extend(edges(part, one, two))
        a, b = ([np.empty(0, np.int64)] + [f[k] for f in found] for k in (0, 1))
        return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b)})

    return met.select("slot", "spot", "x", "y", "block", "id", "root", *columns).groupBy(
        "slot").applyInPandas(run, EDGES)


def alike(percent: int, bits: int):
    """Edges between members of different roots whose counts allow the threshold and whose
    sketches are at most ``bits`` apart."""

    def edges(part, one, two):
        ids, root, n, s1, s2 = (part[c].to_numpy() for c in ("id", "root", "n", "s1", "s2"))
        near = root[one][:, None] != root[two]
        if not near.any():
            return
        x, y = n[one][:, None], n[two]
        near &= 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
        near &= (np.bitwise_count((s1[one][:, None] ^ s1[two]).view(np.uint64))
                 + np.bitwise_count((s2[one][:, None] ^ s2[two]).view(np.uint64))) <= bits
        rows, columns = near.any(1), near.any(0)
        if not rows.any():
            return
        near, one, two = near[rows][:, columns], ids[one[rows]], ids[two[columns]]
        # The smallest id that edges of this meeting lead to.
        low, none = one.copy(), np.iinfo(np.int64).max
        while True:
            low_two = np.minimum(two, np.where(near, low[:, None], none).min(0))
            new = np.minimum(low, np.where(near, low_two, none).min(1))
            if (new == low).all():
                break
            low = new
        yield np.concatenate([one, two]), np.concatenate([low, low_two])

    return edges


def linked(percent: int):
    """Edges between members whose sets, ``codes``, are linked. Members that are of one component
    by then are not compared: that could not change the components."""

    def edges(part, one, two):
        ids = part["id"].to_numpy()
        place = np.union1d(one, two)
        _, root = np.unique(part["root"].to_numpy()[place], return_inverse=True)
        sets = [np.asarray(c) for c in part["codes"].iloc[place]]
        size = np.array([len(c) for c in sets])
        _, code = np.unique(np.concatenate(sets), return_inverse=True)
        ends = np.cumsum(size)
        start = ends - size
        mark = np.zeros(code.max() + 1, bool)
        alone = np.array_equal(one, two)
        one, other = np.searchsorted(place, one), np.searchsorted(place, two)
        a, b = [], []
        for i in one:
            two = other[other > i] if alone else other
            fits = 100 * np.minimum(size[i], size[two]) >= percent * np.maximum(size[i], size[two])
            rest = two[fits & (root[two] != root[i])]
            if not len(rest):
                continue
            mine = code[start[i] : ends[i]]
            mark[mine] = True
            here = np.concatenate([code[start[j] : ends[j]] for j in rest])
            common = np.add.reduceat(mark[here], np.cumsum(size[rest]) - size[rest], dtype=np.int64)
            mark[mine] = False
            for j in rest[100 * common >= percent * (size[i] + size[rest] - common)]:
                if root[j] != root[i]:
                    a.append(ids[place[i]])
                    b.append(ids[place[j]])
                    root[root == root[j]] = root[i]
        if a:
            yield np.array(a, np.int64), np.array(b, np.int64)

    return edges
