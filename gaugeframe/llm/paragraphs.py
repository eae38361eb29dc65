"""Repeated paragraphs: MinHash bands with high recall, exact Jaccard, removals by components.

Paragraphs are lines. Every line of at least five words goes through the bands of the near-copy
operator; as many bands are used as bring two lines at the threshold into one bucket with a
probability of 0.9999, and all that share one are decided. Colliding lines are confirmed on their
full shingle sets, and of each component only the line of the smallest (doc_id, place) stays. Equal
lines are one class before the bands, so a line in a third of all documents costs no more than a
rare one.

Long passages that do not make up a line are found beside that by ``passages``: units of words cut
by content, equal units joined.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugeframe.llm.near_copies import bands_for, near_copies
from gaugeframe.llm.passages import LONG as LONG_WORDS
from gaugeframe.llm.passages import repeated_passages, without_passages
from gaugeframe.llm.rows import sized
from gaugeframe.llm.text import in_parts
from gaugeframe.sources.scratch import materialize

SIZE, PERCENT, RECALL = 5, 80, 0.9999
# Two minima a band: lines have few shingles, and strangers hardly share one of five words.
BAND_ROWS = 2
ROW = "__gf_row"
_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]"
# Lines of at least five words.
LONG = rf"^{_SPACE}*+(?:{_WORD}++{_SPACE}++){{{SIZE - 1}}}{_WORD}"


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with the number of each row's first line, stored. A null text is one empty line."""
    schema = T.StructType([*docs.schema.fields, T.StructField(ROW, T.LongType(), False)])
    at = docs.columns.index("text")

    def run(batches):
        next_line = TaskContext.get().partitionId() << 40
        for batch in in_parts(batches, at):
            breaks = pc.fill_null(pc.count_substring(batch.column(at), "\n"), 0)
            ends = np.cumsum(breaks.to_numpy(zero_copy_only=False).astype(np.int64) + 1)
            first = next_line + np.concatenate([[0], ends])
            next_line = int(first[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(first[:-1])], names=schema.names)

    return materialize(docs.mapInArrow(run, schema), "rows")


def _lines(rows: DataFrame) -> DataFrame:
    """``(row, doc_id, place, text, line)``."""
    text = F.split(F.coalesce("text", F.lit("")), "\n")
    lines = rows.select(
        F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.posexplode(text).alias("place", "text"))
    return lines.withColumn("line", F.col("row") + F.col("place"))


def _repeated(lines: DataFrame) -> DataFrame:
    """Per row with repeated lines: ``n_repeated`` of them, ``n_long_lines`` that have many words
    and are in other rows too, the ``places`` of those that go and the doc_ids that keep them."""
    found = materialize(near_copies(
        lines.where(F.col("text").rlike(LONG)).select(F.col("line").alias("doc_id"), "text"),
        SIZE, PERCENT, bands_for(PERCENT, RECALL, BAND_ROWS), BAND_ROWS), "found")
    shared = materialize(
        found.where(~F.col("kept")).select(F.col("component_id").alias("shared")).distinct(),
        "shared")
    members = found.join(
        sized(shared), found["component_id"] == F.col("shared"), "left_semi").select(
            F.col("doc_id").alias("line"), "component_id",
            (F.col("n_shingles") > LONG_WORDS - SIZE).alias("wide"))
    members = materialize(
        members.join(lines.select("line", "row", "doc_id", "place"), "line"), "members")
    first = materialize(
        members.groupBy("component_id").agg(
            F.min(F.struct("doc_id", "place", "row", "line")).alias("first"),
            (F.min("row") < F.max("row")).alias("across"))
        .select("component_id", F.col("first.line").alias("stays"),
                F.col("first.doc_id").alias("kept_in"), "across"), "first")
    goes = F.when(F.col("line") != F.col("stays"), F.struct("place", "kept_in"))
    return members.join(first, "component_id").groupBy("row").agg(
        F.count("*").alias("n_repeated"),
        F.count_if(F.col("wide") & F.col("across")).alias("n_long_lines"),
        F.array_sort(F.collect_list(goes)).alias("gone")).select(
            "row", "n_repeated", "n_long_lines", F.col("gone.place").alias("places"),
            F.col("gone.kept_in").alias("kept_in"))


def repeated_paragraphs(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_paragraphs, n_repeated, n_removed, repeats, removed, kept_in, n_long,
    n_long_lines, passages)`` per row of ``docs (doc_id, text)``.

    Lines of at least five words are linked at a Jaccard similarity of 0.8 of their sets of five
    consecutive words. ``n_repeated`` counts the lines that are linked with any. One line of each
    component stays, that of the smallest (doc_id, place); the others are ``removed`` (their
    numbers, from 0, sorted), and ``kept_in`` names the document of the line that stays for each
    of them. ``repeats`` is true where any line goes.

    ``passages`` are stretches of many words that another row holds as well, as
    ``(start, end)`` in words of the whole text (``passages.repeated_passages``), wherever lines
    begin; ``n_long`` counts them. ``n_long_lines`` counts the repeated lines with more than 46
    different shingles that are linked with another row.

    A null text is one empty line. Rows that share a doc_id are treated as different documents.
    Other columns of ``docs`` are not looked at. An empty table gives an empty result.
    """
    rows = _numbered(docs.select("doc_id", "text"))
    lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n")).cast("long")
    per_row = rows.select(F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
                          lines.alias("n_paragraphs"))
    found = repeated_passages(rows.select(F.col(ROW).alias("row"), "text"))
    none = lambda kind: F.array().cast(f"array<{kind}>")
    size, long = (F.coalesce(F.size(c), F.lit(0)) for c in ("places", "passages"))
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return per_row.join(_repeated(_lines(rows)), "row", "left").join(found, "row", "left").select(
        "doc_id", "n_paragraphs", count("n_repeated"), size.alias("n_removed"),
        (size > 0).alias("repeats"), F.coalesce("places", none("int")).alias("removed"),
        F.coalesce("kept_in", none("bigint")).alias("kept_in"), long.alias("n_long"),
        count("n_long_lines"),
        F.coalesce("passages", none("struct<start:int,end:int>")).alias("passages"))


def drop_repeated_paragraphs(docs: DataFrame, passages: bool = False) -> DataFrame:
    """``docs`` with all columns, its texts without the lines that ``repeated_paragraphs`` removes.

    With ``passages`` the long passages that are left in several texts then go as well, but for
    the first text that holds each. A text that loses every line becomes empty; a null text stays null.
    """
    rows = _numbered(docs)
    gone = materialize(_repeated(_lines(rows.select("doc_id", "text", ROW))).where(
        F.size("places") > 0), "gone")
    kept = F.array_join(F.filter(
        F.split("text", "\n"), lambda x, place: ~F.array_contains("__gf_places", place)), "\n")
    text = F.when(F.col("__gf_places").isNull(), F.col("text")).otherwise(kept)
    gone = gone.select(F.col("row").alias("__gf_at"), F.col("places").alias("__gf_places"))
    out = rows.join(gone, rows[ROW] == F.col("__gf_at"), "left").select(
        *[text.alias(c) if c == "text" else F.col(c) for c in rows.columns])
    if passages:
        out = without_passages(materialize(out, "lines-dropped"), ROW)
    return out.select(*docs.columns)
