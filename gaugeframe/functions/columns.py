"""Column expressions shared by every operator."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from types import MappingProxyType

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


# More aggregates than this in one operator outgrow what the JVM compiles to native code.
AGGS_PER_SCAN = 16


def ident(name: str) -> str:
    """A quoted SQL name; it may hold spaces, dots, quotes or slashes."""
    return "`" + name.replace("`", "``") + "`"


def ref(name: str) -> Column:
    return F.col(ident(name))


def text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(value: float | None) -> str:
    """A SQL double literal."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    return f"{float(value)!r}D" if math.isfinite(value) else f"double('{float(value)}')"


def nan_to_null(col: Column, dtype: T.DataType) -> Column:
    """One notion of "missing": NaN in a float column counts as NULL."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(col), col)
    return col


def _canonical_sql(field: T.StructField) -> str:
    q = ident(field.name)
    if isinstance(field.dataType, T.DecimalType):
        return f"CAST({q} AS DOUBLE)"
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return f"CASE WHEN NOT isnan({q}) THEN {q} END"
    return q


def canonical(df: DataFrame) -> DataFrame:
    """Cast decimals to double and turn NaN into NULL; other columns pass untouched."""
    fields = df.schema.fields
    if not any(isinstance(f.dataType, (T.DecimalType, T.FloatType, T.DoubleType)) for f in fields):
        return df
    return df.selectExpr(*[f"{_canonical_sql(f)} AS {ident(f.name)}" for f in fields])


def doubles(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Only ``cols``, as doubles with NaN as NULL. Prunes the scan to those columns."""
    if not cols:
        raise ValueError("no columns to summarise")
    fields = {f.name: f for f in df.schema.fields}
    for name in cols:
        if not isinstance(fields[name].dataType, T.NumericType):
            kind = fields[name].dataType.simpleString()
            raise TypeError(f"column {name!r} is {kind}, not numeric")
    return df.selectExpr(*[
        f"CAST({_canonical_sql(fields[c])} AS DOUBLE) AS {ident(c)}" for c in cols])


def unpivoted(df: DataFrame, rows: Sequence[Sequence[str]], names: Sequence[str]) -> DataFrame:
    """Every row of ``df`` once per item of ``rows``, which holds SQL for each of ``names``."""
    cells = ", ".join(sql for row in rows for sql in row)
    return df.selectExpr(f"stack({len(rows)}, {cells}) AS ({', '.join(names)})")


def column_stats(
    df: DataFrame, cols: Sequence[str], aggs: Mapping[str, str],
    params: Mapping[str, Sequence[float | None]] = MappingProxyType({}),
) -> DataFrame:
    """One row per column: ``column_name``, its ``params`` and ``aggs`` (SQL) over its ``value``.

    All columns are read in one scan, unpivoted, and aggregated by column with one buffer per
    column and task before the shuffle. ``params`` are doubles per column that ``aggs`` may use.
    Without rows every aggregate is null.
    """
    names = ["column_no", "value", *params]
    cells = [[str(i), ident(c), *(number(v[i]) for v in params.values())]
             for i, c in enumerate(cols)]
    found = unpivoted(doubles(df, cols), cells, names).groupBy("column_no").agg(
        *[F.expr(sql).alias(name) for name, sql in aggs.items()])
    schema = "column_no int, column_name string" + "".join(f", {p} double" for p in params)
    known = small_table(df.sparkSession, [
        (i, c, *(v[i] for v in params.values())) for i, c in enumerate(cols)], schema)
    # One row per column.
    return known.join(F.broadcast(found), "column_no", "left").drop("column_no")


def safe_div(num: Column, den: Column) -> Column:
    """Division that yields 0 where the divisor is zero or missing."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(0.0))


def iqr_cap(col: Column, lo: float, hi: float) -> Column:
    """Clip to [lo, hi]. ``greatest``/``least`` skip nulls, so nulls are kept explicitly."""
    return F.when(col.isNotNull(), F.greatest(F.lit(lo), F.least(F.lit(hi), col)))


def tall(wide: DataFrame, rows: Sequence[dict[str, str]]) -> DataFrame:
    """Reshape a one-row aggregate into one output row per dict of SQL, without a shuffle."""
    structs = [
        "named_struct(" + ", ".join(f"'{name}', {sql}" for name, sql in row.items()) + ")"
        for row in rows]
    return wide.selectExpr(f"inline(array({', '.join(structs)}))")


def stacked(df: DataFrame, items: Sequence[tuple[Sequence[str], dict[str, str]]]) -> DataFrame:
    """One output row per item: its aggregates ("sql AS name"), and the row made from them.

    Items are grouped into aggregates small enough to be compiled well, each of which scans
    only its own columns; their union runs as one job. SQL text keeps a wide table from
    costing thousands of calls to build expressions.
    """
    if not items:
        raise ValueError("no columns to summarise")
    groups: list[list] = []
    room = 0
    for item in items:
        if len(item[0]) > room:
            groups.append([])
            room = AGGS_PER_SCAN
        groups[-1].append(item)
        room -= len(item[0])
    parts = [tall(df.selectExpr(*[a for aggs, _ in g for a in aggs]), [row for _, row in g])
             for g in groups]
    return reduce(DataFrame.unionByName, parts)


def small_table(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A few fitted values as a local relation: no job, and a size the planner knows."""
    fields = to_arrow_schema(T.StructType.fromDDL(schema))
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(
        pa.table([pa.array(c, f.type) for c, f in zip(columns, fields)], schema=fields))

