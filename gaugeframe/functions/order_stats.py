"""Exact quantiles that stay within bounded memory at any table size, by radix selection.

A double has an order-preserving image among the 64-bit integers: the bits of its magnitude, with
its sign. Columns are unpivoted, and each pass counts the values of every column by the next bits of
their images, with a map-side-combined ``groupBy(slot, digit)``. A slot is a range of images that
holds the rank of a quantile; the digit that holds it is the slot of the next pass. A slot is
done when its smallest and largest value are equal. The first pass looks at 16 bits, each further
one at 12, so there are at most five; a slot with few values left is listed by value at once.
Passes after the first read only columns with open slots, and take images only of values in them.

Nothing is sketched, and no task holds more than the counts of one slot: 65,536 in the first pass,
4,096 or ``countable`` later. The driver gets one row per column and rank.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeframe.functions.columns import doubles, ident, ref, small_table, unpivoted

COUNTABLE = 10_000
FIRST_BITS, BITS = 16, 12
_MANTISSA, _BIAS = 52, 1023
_LEAST, _LARGEST = 2.0**-1022, math.nextafter(math.inf, 0)  # of the normal doubles


def _ratio(size: Column, power: Column) -> Column:
    """Bits of a normal double beyond those of a power of two that is at most one step away.

    Doubles between two powers of two are evenly spaced, so the bits are a line with a bend at 1
    and at 2. Every term is exact.
    """
    r = size / power - 1
    line = F.least(r, F.lit(0.0)) * 2 + F.least(F.greatest(r, F.lit(0.0)), F.lit(1.0)) + (
        F.greatest(r - 1, F.lit(0.0)) / 2)
    return (line * float(1 << _MANTISSA)).cast("long")


def image(value: Column) -> Column:
    """The order-preserving 64-bit image of a double that is not NaN; both zeros give 0.

    The logarithm only has to be right to the nearest power of two. No part depends on a
    condition, so that Spark computes the parts that occur several times once per row.
    """
    size = F.abs(value)
    normal = F.least(F.greatest(size, F.lit(_LEAST)), F.lit(_LARGEST))
    near = F.least(F.greatest(F.floor(F.log2(normal)), F.lit(1 - _BIAS)), F.lit(_BIAS))
    bits = (near + _BIAS) * F.lit(1 << _MANTISSA) + _ratio(normal, F.pow(F.lit(2.0), near))
    # Below the smallest normal double the magnitude is a multiple of 2^-1074.
    small = (F.least(size, F.lit(_LEAST)) * 2.0**537 * 2.0**537).cast("long")
    bits = bits + small - F.lit(1 << _MANTISSA) + (size > _LARGEST).cast("long")
    return bits * F.signum(value).cast("long")


def _counted(values: DataFrame, slots: DataFrame | None = None) -> DataFrame:
    """``(slot, digit, n, low, high, upto)``: counts by digit, and counts up to each digit.

    ``values`` holds ``(column_no, value)``, ``slots`` a few rows of
    ``(slot, column_no, least, most, shift)``; without them a column is a slot, in the first bits.
    Slots are met by value, so that images are computed only of the values inside one.
    """
    if slots is None:
        inside = values.selectExpr("column_no AS slot", "value", f"{64 - FIRST_BITS} AS shift")
    else:
        inside = values.join(F.broadcast(slots), "column_no").where("value BETWEEN least AND most")
    digits = inside.select("slot", F.call_function(
        "shiftright", image(F.col("value")), F.col("shift")).alias("digit"), "value")
    counts = digits.groupBy("slot", "digit").agg(
        F.count("*").alias("n"), F.min("value").alias("low"), F.max("value").alias("high"))
    order = Window.partitionBy("slot").orderBy("digit")
    return counts.withColumn("upto", F.sum("n").over(order))


def _ranks(prob: float, n: int) -> tuple[int, int, float]:
    position = prob * (n - 1)
    low = math.floor(position)
    return low, min(low + 1, n - 1), position - low


def _between(low: float, high: float, part: float) -> float:
    # Between equal or infinite values nothing is interpolated.
    return low if not part or low == high else low + (high - low) * part


@dataclass
class _Slot:
    """The values of one column from ``least`` to ``most``, counted in steps of 2^``shift``."""

    column: int
    least: float
    most: float
    shift: int
    asked: dict[int, int] = field(default_factory=dict)  # rank inside it: rank in the column


def _narrowed(slots: list[_Slot], found: list, known: dict, countable: int) -> list[_Slot]:
    """The slots of the next pass; ranks whose value is certain go to ``known``."""
    nexts: dict[tuple[int, int], _Slot] = {}
    for r in found:
        slot, before = slots[r["slot"]], r["upto"] - r["n"]
        for inner, rank in slot.asked.items():
            if not before <= inner < r["upto"]:
                continue
            if r["low"] == r["high"]:
                known[slot.column, rank] = r["low"]
                continue
            shift = 0 if r["n"] <= countable else max(0, slot.shift - BITS)
            narrow = _Slot(slot.column, r["low"], r["high"], shift)
            nexts.setdefault((slot.column, r["low"]), narrow).asked[inner - before] = rank
    return list(nexts.values())


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], countable: int = COUNTABLE
) -> dict[str, list[float | None]]:
    """Linear-interpolated quantiles of each column over its non-null values.

    Infinite values count like others. A column without values has null quantiles. A slot of at
    most ``countable`` values is listed by value.
    """
    spark = df.sparkSession

    def values(places: Sequence[int]) -> DataFrame:
        return unpivoted(doubles(df, [cols[i] for i in places]),
                         [[str(i), ident(cols[i])] for i in places],
                         ["column_no", "value"]).where("value IS NOT NULL")

    # The first pass also tells the number of values, from which the ranks follow.
    rows = _counted(values(range(len(cols)))).withColumn("total", F.sum("n").over(Window.partitionBy("slot")))
    place = [F.floor(p * (F.col("total") - 1)).cast("long") for p in map(float, probs)]
    rows = rows.select("*", F.explode(F.array(*place)).alias("at"))
    rows = rows.select("*", F.explode(F.array(
        "at", F.least(F.col("at") + 1, F.col("total") - 1))).alias("rank")).drop("at")
    found = rows.where("upto - n <= rank AND rank < upto").distinct().collect()

    totals = {r["slot"]: r["total"] for r in found}
    known: dict[tuple[int, int], float] = {}  # of column and rank
    slots = [_Slot(i, -math.inf, math.inf, 64 - FIRST_BITS) for i in range(len(cols))]
    for r in found:
        slots[r["slot"]].asked[r["rank"]] = r["rank"]
    slots = _narrowed(slots, found, known, countable)
    while slots:
        table = small_table(spark, [(k, s.column, s.least, s.most, s.shift) for k, s in enumerate(slots)],
                            "slot int, column_no int, least double, most double, shift int")
        wanted = small_table(spark, [(k, inner) for k, s in enumerate(slots) for inner in s.asked],
                             "slot int, inner long")
        # A row per slot and rank on both sides.
        open_columns = sorted({s.column for s in slots})
        found = _counted(values(open_columns), table).join(F.broadcast(wanted), "slot").where(
            "upto - n <= inner AND inner < upto").drop("inner").distinct().collect()
        slots = _narrowed(slots, found, known, countable)

    out = {}
    for i, c in enumerate(cols):
        ranks = [_ranks(p, totals[i]) if i in totals else None for p in probs]
        out[c] = [None if r is None else _between(known[i, r[0]], known[i, r[1]], r[2])
                  for r in ranks]
    return out


def sketch_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], accuracy: int = 10_000
) -> dict[str, list[float | None]]:
    """One-pass approximate quantiles (actual column values, rank error 1/accuracy)."""
    row = doubles(df, cols).agg(
        *[F.percentile_approx(ref(c), list(probs), accuracy).alias(f"q{i}")
          for i, c in enumerate(cols)]
    ).first()
    return {c: list(row[f"q{i}"] or [None] * len(probs)) for i, c in enumerate(cols)}


def quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], exact: bool = True
) -> dict[str, list[float | None]]:
    if not cols:
        return {}
    return exact_quantiles(df, cols, probs) if exact else sketch_quantiles(df, cols, probs)
