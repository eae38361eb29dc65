"""From raw rows to model-ready features, labels and splits."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeframe.functions.columns import canonical, ref
from gaugeframe.functions.hashrank import row_identity
from gaugeframe.operators import clean, encode, split
from gaugeframe.sources.scratch import materialize
from gaugeframe.sources.tables import column_roles

KEY = "__gf_row"


@dataclass(frozen=True)
class Prepared:
    """Features, ``label``, ``split`` and the row id in one table, with what was learned.

    ``inputs`` are the columns that features are made of. ``plans.stored`` keeps all but the table
    for later rows.
    """

    df: DataFrame
    features: list[str]
    classes: list[str] | None
    missing: clean.MissingFit
    caps: dict[str, tuple[float, float]]
    encoding: encode.EncodingFit
    scale: dict[str, tuple[float, float]]
    target: str = ""
    inputs: list[str] = field(default_factory=list)
    fill_unseen: bool = False


def prepare(
    df: DataFrame,
    target: str,
    fit_on: str = "all",
    test: float = 0.15,
    val: float = 0.15,
    seed: int = 42,
    key: str | Sequence[str] | None = None,
    exclude: Sequence[str] = (),
    impute_target: bool = True,
    skip_zero_iqr: bool = False,
    exact: bool = True,
) -> Prepared:
    """Fill gaps, drop duplicates, cap outliers, encode, scale, index the target, split.

    ``fit_on="all"`` learns every parameter from all rows; ``"train"`` splits first and
    learns from the training rows only, which keeps test rows out of the parameters.
    A value not seen there takes code 2 in a binary column, no indicator, and the share 0.
    ``exclude`` names columns (such as ids) to keep out of the features, as they are; ``key`` is a unique
    id for the split, by default the whole deduplicated row.
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on must be 'all' or 'train'")
    roles = column_roles(df, target)
    unusable = [c for c in roles.other if c not in exclude]
    unusable = [c for c in unusable if df.schema[c].dataType.typeName() != "boolean"]
    if unusable:
        raise TypeError(f"columns {unusable} are neither numbers nor text: drop or convert them")
    if key is not None:
        named = [key] if isinstance(key, str) else list(key)
        lost = [c for c in named if c not in df.columns]
        if lost:
            raise ValueError(f"key columns {lost} are not in the table")

    df = canonical(df)
    # Ids are never fitted, dropped or filled.
    untouched = {*exclude, *([key] if isinstance(key, str) else key or ())}
    if fit_on == "all":
        missing = clean.fit_missing(
            df, target, impute_target, exact=exact, untouched=[c for c in untouched if c != target])
        rows = clean.drop_duplicates(clean.apply_missing(df, missing))
    else:
        modes = clean.fit_modes(df, [target]) if impute_target else {}
        rows = clean.drop_duplicates(clean.apply_missing(df, clean.MissingFit(modes=modes)))
    if not impute_target:
        rows = rows.where(ref(target).isNotNull())
    # The one wide write: later passes scan it column by column. The split key is stored with
    # it, because capping may make rows equal that were distinct.
    rows = materialize(rows.withColumn(KEY, row_identity(rows, key)), "clean-rows")

    classes = encode.fit_target(rows, target)
    labelled = encode.apply_target(rows, target, classes, "label")
    labelled = split.stratified_split(labelled, "label", test, val, seed, KEY)
    if fit_on == "train":
        # Every parameter is learned from a scan of the training rows: stored, they are not hashed
        # and looked up again each time.
        labelled = materialize(labelled, "split-rows")

    # ``learn`` is what parameters are learned from; every step is applied to both tables.
    learn = rows if fit_on == "all" else labelled.where(F.col("split") == "train")
    rows = labelled
    plain = [KEY, "label", "split", target, *exclude]
    if fit_on == "train":
        inputs = [c for c in rows.columns
                  if c not in (KEY, "label", "split", target) and c not in untouched]
        # Rows outside training may have gaps that training rows do not show.
        missing = clean.fit_missing(
            learn.select(*[ref(c) for c in inputs]), exact=exact, every_column=True)
        learn, rows = (clean.apply_missing(t, missing) for t in (learn, rows))

    numeric = [c for c in column_roles(rows).numeric if c not in plain]
    caps = clean.fit_caps(learn, numeric, skip_zero_iqr=skip_zero_iqr, exact=exact)
    learn, rows = (clean.apply_caps(t, caps) for t in (learn, rows))

    text = [c for c in column_roles(rows).categorical if c not in plain]
    inputs = [c for c in rows.columns if c not in plain]
    encoding = encode.fit_encoding(learn, text)
    rows = encode.apply_encoding(rows, encoding)
    if fit_on == "train" and encoding.shares:
        # A value never seen in training has no share.
        rows = rows.fillna(0.0, list(encoding.shares))

    # The moments of shares are known from their counts; only the others need a scan.
    learn = encode.apply_encoding(learn, replace(encoding, shares={}))
    numeric = [c for c in column_roles(learn).numeric if c not in plain]
    scale = encode.fit_scale(learn, numeric)
    scale |= {c: (s.mean, s.std or 1.0) for c, s in encoding.shares.items()}
    rows = encode.apply_scale(rows, scale)
    features = [c for c in rows.columns if c not in plain]
    kept = [*features, *exclude, "label", "split", KEY]
    out = rows.select(*[ref(c) for c in kept])
    if fit_on == "train":
        missing = replace(missing, modes={**missing.modes, **modes})
    return Prepared(out, features, classes, missing, caps, encoding, scale, target, inputs,
                    fit_on == "train")
