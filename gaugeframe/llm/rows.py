"""Small DataFrame helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeframe.sources.scratch import materialize

# Ids sent to every executor: at most this many longs (32 MB).
BROADCAST_IDS = 4_000_000


def crc32_fold(doc_id: str, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; null for no id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(folds))


def sized(ids: DataFrame) -> DataFrame:
    """``ids`` (one column of longs) marked for broadcast if its counted size allows it."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def with_row_id(docs: DataFrame, name: str) -> DataFrame:
    """Adds an id that is never null: the doc_id, or for rows without one a number from 2^62 on,
    made of the text. Rows without id and with equal texts so count as one document, and a
    document with an id goes before them."""
    made = F.lit(1 << 62) + F.pmod(F.xxhash64("text"), F.lit(1 << 61))
    return docs.withColumn(name, F.coalesce(F.col("doc_id").cast("long"), made))


def drop_ids(docs: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """The rows whose ``key`` is not in ``ids`` (stored, one column)."""
    gone = ids.toDF("__gf_gone")
    return docs.join(sized(gone), docs[key] == F.col("__gf_gone"), "left_anti")


def one_row_per_id(docs: DataFrame, key: str) -> DataFrame:
    """Of rows that repeat a ``key``, the smallest.

    Ids are counted without the other columns; only rows of repeated ids are compared.
    """
    again = materialize(docs.groupBy(key).count().where("count > 1").select(key), "repeated")
    if not again.head(1):
        return docs
    first = docs.join(again, key, "left_semi").groupBy(key).agg(
        F.min(F.struct(*docs.columns)).alias("__gf_row")).select("__gf_row.*")
    return docs.join(again, key, "left_anti").unionByName(first.select(*docs.columns))
