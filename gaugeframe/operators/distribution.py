"""Correlations, histograms, densities and box statistics: the data behind the plots."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.functions.columns import (
    column_stats,
    doubles,
    ident,
    number,
    ref,
    small_table,
    stacked,
    unpivoted,
)
from gaugeframe.functions.order_stats import quantiles
from gaugeframe.operators.profile import FENCE
from gaugeframe.sources.tables import column_roles

SNAP = 1e-12
UNSURE = 1e-8
DIRECT_PAIRS = 45
REACH = 39.0
FINE = 8  # bins in a bandwidth
BIN_SCHEMA = "column_name string, bin int, bin_start double, bin_end double"


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Pearson correlation of every ordered pair over the rows where both are present.

    One pass sizes the columns. A few pairs are then aggregated one by one; for many, a single
    pass sums all products of the standardised values, their squares and the presence of each
    column with gaps, and every pair follows from those sums. NULL when either side is constant
    or empty. Values within 1e-12 of +-1 are set to +-1, so that the order in which partial sums
    arrive cannot decide whether a pair is perfect.
    """
    cols = list(cols) if cols is not None else column_roles(df).numeric
    nums = doubles(df, cols)
    sizes = column_stats(df, cols, {
        "gaps": "count(*) - count(value)", "mean": "avg(value)", "sd": "stddev_pop(value)"})
    place = {c: i for i, c in enumerate(cols)}
    size = {place[r["column_name"]]: r for r in sizes.collect()}
    live = [i for i in range(len(cols)) if size[i]["sd"]]
    holes = [i for i in live if size[i]["gaps"]]
    found = {(i, i): 1.0 for i in live}
    pairs = [(i, j) for k, i in enumerate(live) for j in live[:k]]
    spread = {i: size[i]["sd"] for i in live}
    if len(pairs) > DIRECT_PAIRS:
        known, pairs = _pairs_from_sums(
            nums, cols, live, holes, {i: size[i]["mean"] for i in live}, spread)
        found |= known
    found |= _pairs_directly(nums, cols, pairs, holes, spread)
    rows = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            r = found.get((i, j), found.get((j, i)))
            if r is not None and abs(r) > 1 - SNAP:
                r = math.copysign(1.0, r)
            rows.append((a, b, r, i, j))
    return small_table(
        df.sparkSession, rows, "a string, b string, corr double, pos_a int, pos_b int")


def _pairs_from_sums(
    nums: DataFrame, cols: Sequence[str], live: list[int], holes: list[int],
    mean: dict[int, float], spread: dict[int, float],
) -> tuple[dict[tuple[int, int], float], list[tuple[int, int]]]:
    """Correlations from the sums of all pairwise products of standardised values.

    Also returns the pairs whose common rows hardly vary, where the sums would cancel.
    """
    z = {i: f"coalesce(({ident(cols[i])} - {number(mean[i])}) / {number(spread[i])}, 0D)"
         for i in live}
    parts = [z[i] for i in live] + [f"{z[i]} * {z[i]}" for i in live] + ["1D"]
    parts += [f"CAST({ident(cols[i])} IS NOT NULL AS DOUBLE)" for i in holes]
    names = [f"p{i}" for i in range(len(parts))]
    wide = nums.selectExpr(*[f"{p} AS {n}" for p, n in zip(parts, names)])
    vectors = VectorAssembler(inputCols=names, outputCol="v").transform(wide).select("v")
    # A tree aggregate of one small matrix per task.
    sums = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")
                     ).computeGramianMatrix().toArray()
    width = len(live)
    place = {i: k for k, i in enumerate(live)}
    present = {i: 2 * width + (1 + holes.index(i) if i in holes else 0) for i in live}

    def moments(i: int, j: int, n: float) -> tuple[float, float]:
        """Mean and mean square of column i over the rows that also have column j."""
        return sums[place[i], present[j]] / n, sums[width + place[i], present[j]] / n

    found, unsure = {}, []
    for k, i in enumerate(live):
        for j in live[:k]:
            n = sums[present[i], present[j]]
            if not n:
                continue
            (mean_i, square_i), (mean_j, square_j) = moments(i, j, n), moments(j, i, n)
            var_i, var_j = square_i - mean_i**2, square_j - mean_j**2
            if var_i <= UNSURE * square_i or var_j <= UNSURE * square_j:
                unsure.append((i, j))
            else:
                cov = sums[place[i], place[j]] / n - mean_i * mean_j
                found[i, j] = float(cov / math.sqrt(var_i * var_j))
    return found, unsure


def _pairs_directly(
    nums: DataFrame, cols: Sequence[str], pairs: Sequence[tuple[int, int]],
    holes: Sequence[int], spread: dict[int, float],
) -> dict[tuple[int, int], float | None]:
    """Correlations by Spark's own moments; conditional ones only against a column with gaps."""
    if not pairs:
        return {}

    def side(i: int, j: int, name: str) -> tuple[list[str], str]:
        if j not in holes:
            return [], number(spread[i])
        x, y = ident(cols[i]), ident(cols[j])
        return [f"stddev_pop({x}) FILTER (WHERE {y} IS NOT NULL) AS {name}"], name

    items = []
    for k, (i, j) in enumerate(pairs):
        (agg_i, sd_i), (agg_j, sd_j) = side(i, j, f"x{k}"), side(j, i, f"y{k}")
        items.append((
            [f"covar_pop({ident(cols[i])}, {ident(cols[j])}) AS c{k}", *agg_i, *agg_j],
            {"k": str(k), "corr": f"try_divide(try_divide(c{k}, {sd_i}), {sd_j})"},
        ))
    return {pairs[r["k"]]: r["corr"] for r in stacked(nums, items).collect()}


def top_correlations(corr: DataFrame, k: int = 20, symmetric: bool = True) -> DataFrame:
    """The k strongest pairs by absolute value, perfect +1 left out, both directions kept."""
    pairs = corr.where(F.col("corr").isNotNull() & (F.col("corr") != 1.0))
    if not symmetric:
        pairs = pairs.where(F.col("pos_a") > F.col("pos_b"))
    return (
        pairs.orderBy(F.abs("corr").desc(), "a", "b").limit(k).select("a", "b", "corr")
    )


def correlation_lower_triangle(corr: DataFrame) -> DataFrame:
    """Strict lower triangle, the cells a masked heat map shows."""
    return corr.where(F.col("pos_a") > F.col("pos_b")).select("a", "b", "corr")


def _ranges(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float] | None]:
    finite = "FILTER (WHERE abs(value) < double('Infinity'))"
    found = column_stats(df, cols, {"lo": f"min(value) {finite}", "hi": f"max(value) {finite}"})
    ends = {r["column_name"]: (r["lo"], r["hi"]) for r in found.collect()}
    out = {}
    for c in cols:
        lo, hi = ends[c]
        if lo is None:
            out[c] = None
        else:
            # A constant column gets a unit-wide range around its value.
            out[c] = (lo, hi) if hi > lo else (lo - 0.5, lo + 0.5)
    return out


def histogram(df: DataFrame, cols: Sequence[str] | None = None, bins: int = 30) -> DataFrame:
    """Equal-width bins between the column's smallest and largest finite value, the last closed.

    Every bin is listed, empty ones with 0. Infinite values, if any, are counted in a bin 0 before
    the first or a bin after the last. A column without finite values has no other bins.
    """
    cols = list(cols) if cols is not None else column_roles(df).numeric
    ranges = _ranges(df, cols)
    known = [ranges[c] or (0.0, 1.0) for c in cols]
    cells = [[str(i), ident(c), number(lo), number(hi - lo)]
             for i, (c, (lo, hi)) in enumerate(zip(cols, known))]
    values = unpivoted(doubles(df, cols), cells, ["column_no", "value", "lo", "width"]).where(
        "value IS NOT NULL")
    inner = f"least(CAST(floor((value - lo) / width * {bins}) AS INT) + 1, {bins})"
    counts = values.selectExpr(
        "column_no",
        f"CASE WHEN value = double('Infinity') THEN {bins + 1} "
        f"WHEN value = double('-Infinity') THEN 0 ELSE {inner} END AS bin",
    ).groupBy("column_no", "bin").agg(F.count("*").alias("n"))
    grid = []
    for i, c in enumerate(cols):
        lo, hi = known[i]
        if ranges[c] is not None:
            grid += [(i, c, b + 1, lo + (hi - lo) * b / bins, lo + (hi - lo) * (b + 1) / bins)
                     for b in range(bins)]
        grid += [(i, c, 0, -math.inf, lo), (i, c, bins + 1, hi, math.inf)]
    grid = small_table(df.sparkSession, grid, f"column_no int, {BIN_SCHEMA}")
    # At most one row per bin.
    return grid.join(F.broadcast(counts), ["column_no", "bin"], "left").where(
        f"n IS NOT NULL OR bin BETWEEN 1 AND {bins}").select(
        "column_name", "bin", "bin_start", "bin_end", F.coalesce("n", F.lit(0)).alias("count"))


def density(df: DataFrame, col: str, points: int = 200, cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on an even grid, bandwidth n^(-1/5) times the sample std.

    The grid spans the data extended by ``cut`` bandwidths (0 stays within the data). Equal
    values are counted once first. Each then adds its kernel to the grid points it reaches:
    beyond REACH bandwidths the kernel is 0 in double precision, and as the bandwidth shrinks
    with the number of rows, so does the number of points. The sums are combined before the
    shuffle, so at most ``points`` rows leave a task.
    """
    nums = doubles(df, [col]).where(ref(col).isNotNull()).select(ref(col).alias("x"))
    stat = nums.agg(F.count("x").alias("n"), F.stddev_samp("x").alias("sd"),
                    F.min("x").alias("lo"), F.max("x").alias("hi")).first()
    if not stat["n"] or not stat["sd"]:
        return small_table(df.sparkSession, [], "point int, x double, density double")
    n, width = stat["n"], stat["sd"] * stat["n"] ** -0.2
    lo, hi = stat["lo"] - cut * width, stat["hi"] + cut * width
    step = (hi - lo) / (points - 1)

    def nearest(side: str, reach: float) -> str:
        return f"CAST({side}((x - {number(lo)} + {number(reach)}) / {number(step)}) AS INT)"

    reached = (f"sequence(greatest(0, {nearest('ceil', -REACH * width)}), "
               f"least({points - 1}, {nearest('floor', REACH * width)}))")
    spread = nums.groupBy("x").agg(F.count("*").alias("w")).selectExpr(
        "x", "w", f"explode({reached}) AS point")
    z = (F.lit(lo) + F.col("point") * F.lit(step) - F.col("x")) / F.lit(width)
    scale = 1.0 / (n * width * math.sqrt(2 * math.pi))
    sums = spread.groupBy("point").agg(
        (F.sum(F.col("w") * F.exp(-0.5 * z * z)) * F.lit(scale)).alias("density"))
    grid = small_table(df.sparkSession, [(i, lo + i * step) for i in range(points)],
                       "point int, x double")
    return grid.join(sums, "point", "left").select(
        "point", "x", F.coalesce("density", F.lit(0.0)).alias("density"))


def density_columns(
    df: DataFrame, cols: Sequence[str] | None = None, points: int = 200, cut: float = 3.0,
    fine: int = FINE,
) -> DataFrame:
    """``(column_name, point, x, density)``: the density of every column, by linear binning.

    Bandwidth and grid are those of ``density``. Each value shares its weight between the two bin
    edges around it, ``fine`` of which make a bandwidth; the bins are counted in one scan of all
    columns, and the kernel is then summed over bins instead of values. Bins out of reach of every
    grid point are left out, so that their number depends on ``points`` and ``fine`` alone. The
    result differs from ``density`` by about 1 / (8 fine^2) of the curve's height. Infinite values
    are not counted; columns without spread have no rows.
    """
    cols = list(cols) if cols is not None else column_roles(df).numeric
    finite = "FILTER (WHERE abs(value) < double('Infinity'))"
    stats = column_stats(df, cols, {
        "n": f"count(value) {finite}", "sd": f"stddev_samp(value) {finite}",
        "lo": f"min(value) {finite}", "hi": f"max(value) {finite}"})
    known = {r["column_name"]: r for r in stats.collect() if r["n"] and r["sd"]}
    known = {c: known[c] for c in cols if c in known}
    fields = "column_no int, column_name string, point int, x double, scale double, width double"
    grid, cells, params = [], [], []
    for i, (c, r) in enumerate(known.items()):
        width = r["sd"] * r["n"] ** -0.2
        lo, hi = r["lo"] - cut * width, r["hi"] + cut * width
        step, scale = (hi - lo) / (points - 1), 1.0 / (r["n"] * width * math.sqrt(2 * math.pi))
        grid += [(i, c, k, lo + k * step, scale, width) for k in range(points)]
        cells.append([str(i), ident(c), number(lo), number(width / fine), number(step)])
        params.append((i, lo, width / fine, step, width))
    grid = small_table(df.sparkSession, grid, fields)
    if not known:
        return grid.select("column_name", "point", "x", F.lit(0.0).alias("density"))
    values = unpivoted(doubles(df, list(known)), cells, ["column_no", "value", "lo", "bin", "step"])
    # Far from every grid point a kernel is 0 in double precision.
    off = "abs((value - lo) - step * round((value - lo) / step))"
    values = values.where(f"abs(value) < double('Infinity') AND {off} <= {REACH * fine + 1} * bin")
    counts = values.selectExpr("column_no", "(value - lo) / bin AS at").groupBy(
        "column_no", F.floor("at").alias("edge")).agg(
            F.count("*").alias("n"), F.sum(F.col("at") - F.floor("at")).alias("upper"))
    edges = counts.select("column_no", F.inline(F.array(
        F.struct(F.col("edge"), (F.col("n") - F.col("upper")).alias("weight")),
        F.struct((F.col("edge") + 1).alias("edge"), F.col("upper").alias("weight")))))
    places = small_table(df.sparkSession, params,
                         "column_no int, lo double, bin double, step double, width double")
    # One row per column.
    at = edges.join(F.broadcast(places), "column_no").withColumn(
        "center", F.col("lo") + F.col("edge") * F.col("bin"))
    near = f"(center - lo {{}} {REACH} * width) / step"
    reached = at.selectExpr(
        "column_no", "weight", "center", "width", "lo", "step",
        f"explode(sequence(greatest(0, CAST(ceil({near.format('-')}) AS INT)), "
        f"least({points - 1}, CAST(floor({near.format('+')}) AS INT)))) AS point")
    z = (F.col("lo") + F.col("point") * F.col("step") - F.col("center")) / F.col("width")
    sums = reached.groupBy("column_no", "point").agg(
        F.sum(F.col("weight") * F.exp(-0.5 * z * z)).alias("total"))
    return grid.join(sums, ["column_no", "point"], "left").select(
        "column_name", "point", "x",
        (F.coalesce("total", F.lit(0.0)) * F.col("scale")).alias("density"))


def box_stats(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True) -> DataFrame:
    """Quartiles, whiskers (furthest value inside the fences) and outlier count."""
    cols = list(cols) if cols is not None else column_roles(df).numeric
    cuts = quantiles(df, cols, (0.25, 0.5, 0.75), exact)
    spans = [None if q[0] is None else FENCE * (q[2] - q[0]) for q in map(cuts.get, cols)]
    params = {name: [cuts[c][k] for c in cols] for k, name in enumerate(("q1", "median", "q3"))}
    params["low"] = [None if s is None else cuts[c][0] - s for c, s in zip(cols, spans)]
    params["high"] = [None if s is None else cuts[c][2] + s for c, s in zip(cols, spans)]
    found = column_stats(df, cols, {
        "whisker_low": "min(value) FILTER (WHERE value >= low AND value <= high)",
        "whisker_high": "max(value) FILTER (WHERE value >= low AND value <= high)",
        "outliers": "count_if(value < low OR value > high)"}, params)
    return found.select(
        "column_name", "q1", "median", "q3", F.least("whisker_low", "q1").alias("whisker_low"),
        F.greatest("whisker_high", "q3").alias("whisker_high"),
        F.coalesce("outliers", F.lit(0)).alias("outlier_count"))
