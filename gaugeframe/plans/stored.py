"""A fitted preparation as stored tables, and its use on new rows.

``parameters`` is one table of what was learned, a row per value: the step it belongs to, the column,
a position and a text or number. Share tables, which may be large, are a second table by column.
Both are Parquet, so a preparation outlives the session that learned it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeframe.functions.columns import canonical, ref, small_table
from gaugeframe.operators import clean, encode
from gaugeframe.plans.preparation import Prepared

VERSION, REST = 1, "__gf_rest"
SCHEMA = "step string, column_name string, position int, word string, amount double"


@dataclass(frozen=True)
class Preparation:
    """What ``prepare`` has learned, without its rows."""

    target: str
    features: list[str]
    inputs: list[str]
    classes: list[str] | None
    missing: clean.MissingFit
    caps: dict[str, tuple[float, float]]
    encoding: encode.EncodingFit
    scale: dict[str, tuple[float, float]]
    fill_unseen: bool


def preparation(prepared: Prepared) -> Preparation:
    return Preparation(
        prepared.target, prepared.features, prepared.inputs, prepared.classes, prepared.missing,
        prepared.caps, prepared.encoding, prepared.scale, prepared.fill_unseen)


def _rows(p: Preparation) -> list[tuple]:
    out = [("version", None, 0, None, float(VERSION)), ("target", p.target, 0, None, None),
           ("fill_unseen", None, 0, None, float(p.fill_unseen))]

    def listed(step, names):
        out.extend((step, c, k, None, None) for k, c in enumerate(names))

    listed("feature", p.features)
    listed("input", p.inputs)
    listed("dropped", p.missing.dropped)
    out += [("class", None, k, c, None) for k, c in enumerate(p.classes or [])]
    out += [("text_target", None, 0, None, float(p.classes is not None))]
    out += [("median", c, 0, None, float(v)) for c, v in p.missing.medians.items()]
    out += [("mode", c, 0, str(v), None) for c, v in p.missing.modes.items()]
    for c, ends in p.caps.items():
        out += [("cap", c, k, None, float(v)) for k, v in enumerate(ends)]
    for step, columns in (("binary", p.encoding.binary), ("one_hot", p.encoding.one_hot)):
        listed(f"{step}_column", columns)
        out += [(step, c, k, v, None) for c, values in columns.items()
                for k, v in enumerate(values)]
    for c, s in p.encoding.shares.items():
        out += [("share", c, k, None, float(v)) for k, v in enumerate((s.small, s.mean, s.std))]
    for c, pair in p.scale.items():
        out += [("scale", c, k, None, float(v)) for k, v in enumerate(pair)]
    return out


def save_preparation(prepared: Prepared, path: str) -> None:
    """Write the learned parameters and share tables under ``path``; a later one replaces them."""
    learned, spark = preparation(prepared), prepared.df.sparkSession
    # A few rows per column and class.
    small_table(spark, _rows(learned), SCHEMA).coalesce(1).write.mode("overwrite").parquet(
        f"{path}/parameters")
    tables = [s.table.select(F.lit(c).alias("column_name"), "__gf_value", "__gf_share")
              for c, s in learned.encoding.shares.items()]
    shares = small_table(spark, [], "column_name string, __gf_value string, __gf_share double")
    for table in tables:
        shares = shares.unionByName(table)
    shares.write.mode("overwrite").parquet(f"{path}/shares")


def load_preparation(spark: SparkSession, path: str) -> Preparation:
    """What ``save_preparation`` wrote; a table of another version is refused."""
    steps: dict[str, list] = {}
    for r in spark.read.parquet(f"{path}/parameters").collect():
        steps.setdefault(r["step"], []).append(r)
    version = [int(r["amount"]) for r in steps.get("version", [])]
    if version != [VERSION]:
        raise ValueError(f"{path}: parameters of version {version}, not {VERSION}")

    def rows(step):
        return sorted(steps.get(step, []), key=lambda r: r["position"])

    def names(step):
        return [r["column_name"] for r in rows(step)]

    def lists(step, known, field):
        out = {c: [] for c in known}
        for r in rows(step):
            out.setdefault(r["column_name"], []).append(r[field])
        return out

    stored = spark.read.parquet(f"{path}/shares")
    shares = {}
    for c, (small, mean, std) in lists("share", (), "amount").items():
        table = stored.where(F.col("column_name") == c).select("__gf_value", "__gf_share")
        shares[c] = encode.Shares(table, bool(small), mean, std)
    one = {step: rows(step)[0] for step in ("target", "text_target", "fill_unseen")}
    return Preparation(
        one["target"]["column_name"], names("feature"), names("input"),
        [r["word"] for r in rows("class")] if one["text_target"]["amount"] else None,
        clean.MissingFit(names("dropped"),
                         {r["column_name"]: r["amount"] for r in rows("median")},
                         {r["column_name"]: r["word"] for r in rows("mode")}),
        {c: tuple(v) for c, v in lists("cap", (), "amount").items()},
        encode.EncodingFit(lists("binary", names("binary_column"), "word"),
                           lists("one_hot", names("one_hot_column"), "word"), shares),
        {c: tuple(v) for c, v in lists("scale", (), "amount").items()},
        bool(one["fill_unseen"]["amount"]))


def transform(df: DataFrame, learned: Preparation | Prepared) -> DataFrame:
    """New rows with the features of a preparation, other columns beside them.

    Nothing is learned, dropped as a copy or split. ``label`` is added where ``df`` has the target;
    a class that was not learned has no label. Values that were not learned take code 2 in a binary
    column and no indicator, and have no share (0 if only training rows were learned from).
    A column with the name of a feature gives way to it.
    """
    if isinstance(learned, Prepared):
        learned = preparation(learned)
    lost = [c for c in learned.inputs if c not in df.columns]
    if lost:
        raise ValueError(f"columns {lost} are not in the table")
    rows = clean.apply_missing(canonical(df), learned.missing)
    if learned.target in rows.columns:
        rows = encode.apply_target(rows, learned.target, learned.classes, "label")
        rows = rows.drop(learned.target) if learned.target not in learned.inputs else rows
    # Other columns stand aside, so that indicators get the names they were learned with.
    rest = [c for c in rows.columns if c not in learned.inputs]
    rows = rows.select(*[ref(c) for c in learned.inputs],
                       *[ref(c).alias(f"{REST}{k}") for k, c in enumerate(rest)])
    rows = clean.apply_caps(rows, learned.caps)
    rows = encode.apply_encoding(rows, learned.encoding)
    if learned.fill_unseen and learned.encoding.shares:
        rows = rows.fillna(0.0, list(learned.encoding.shares))
    rows = encode.apply_scale(rows, learned.scale)
    made = [c for c in rows.columns if not c.startswith(REST)]
    names = {c.lower() for c in learned.features}
    return rows.select(
        *[ref(c).alias(f) for c, f in zip(made, learned.features, strict=True)],
        *[ref(f"{REST}{k}").alias(c) for k, c in enumerate(rest) if c.lower() not in names])
