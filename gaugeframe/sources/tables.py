"""Reading tables, column roles, and writing results."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gaugeframe.functions.columns import canonical


@dataclass(frozen=True)
class Roles:
    numeric: list[str]
    categorical: list[str]
    other: list[str]
    target: str | None


def load_table(
    spark: SparkSession,
    path: str,
    fmt: str | None = None,
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Read CSV (header, inferred types) or parquet; NaN becomes NULL.

    Inference reads a CSV one extra time, so large files should come with ``schema``.
    """
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else
                  "csv" if path.rstrip("/").endswith((".csv", ".csv.gz")) else None)
    if fmt == "csv":
        reader = spark.read.option("header", True)
        # CSV text "NaN" parses as a double NaN and is canonicalised below.
        reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
        return canonical(reader.csv(path))
    if fmt == "parquet":
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return canonical(reader.parquet(path))
    raise ValueError(f"cannot read {path!r}: provide a CSV or parquet table")


def column_roles(df: DataFrame, target: str | None = None) -> Roles:
    """Numeric and string columns are features; every other type is reported as ``other``."""
    numeric, categorical, other = [], [], []
    for f in df.schema.fields:
        if f.name == target:
            continue
        if isinstance(f.dataType, T.NumericType):
            numeric.append(f.name)
        elif isinstance(f.dataType, T.StringType):
            categorical.append(f.name)
        else:
            other.append(f.name)
    return Roles(numeric, categorical, other, target if target in df.columns else None)


def write_splits(df: DataFrame, path: str) -> None:
    """One parquet table partitioned by split; reading one split prunes the others."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """Nested result rows as JSON lines, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_profile(tables: Mapping[str, DataFrame], path: str) -> None:
    """One CSV folder per profile table under ``path``."""
    for name, table in tables.items():
        table.write.mode("overwrite").option("header", True).csv(f"{path}/{name}")


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
