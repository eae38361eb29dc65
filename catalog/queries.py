"""One Spark query per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import gaugeframe as gf
from catalog.inputs import spark_input, table
from gaugeframe.functions.columns import ident, iqr_cap, ref, tall, text

PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CLASSES = ["click", "error", "purchase", "signup", "view"]
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, so that the order of partial sums does not show."""
    return df.select(*[
        (F.round(ref(f.name), digits) if isinstance(f.dataType, T.DoubleType) else ref(f.name))
        .alias(f.name) for f in df.schema.fields
    ])


def lineitem(spark, sf) -> DataFrame:
    return table(spark, sf, "lineitem")


# --- sources and sinks


@query("S1_load_table")
def _(spark, sf):
    df = gf.load_table(spark, f"{sf}/events.parquet")
    return df.select("event_id", "user_id", "event_type", "value")


@query("S1_load_csv")
def _(spark, sf):
    path = gf.scratch_path(spark, "orders-csv")
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    table(spark, sf, "orders").select(*cols).write.option("header", True).csv(path)
    return gf.load_table(spark, path, "csv")


@query("S2_column_roles")
def _(spark, sf):
    df = lineitem(spark, sf)
    roles = gf.column_roles(df, "l_returnflag")
    named = [(c, "numeric") for c in roles.numeric] + [(c, "other") for c in roles.other]
    named += [(c, "categorical") for c in roles.categorical] + [(roles.target, "target")]
    counts = df.agg(*[F.count(ref(c)).alias(c) for c, _ in named])
    return tall(counts, [{"column_name": text(c), "role": text(r), "filled": ident(c)}
                         for c, r in named])


def _split_orders(spark, sf) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return gf.stratified_split(orders, "o_orderpriority", key="o_orderkey")


@query("S3_write_splits")
def _(spark, sf):
    path = gf.scratch_path(spark, "splits")
    gf.write_splits(_split_orders(spark, sf), path)
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority", "split")


@query("S4_write_metrics")
def _(spark, sf):
    path = gf.scratch_path(spark, "metrics")
    found = _model_metrics(spark, sf)
    gf.write_metrics(found, path)
    back = spark.read.schema(found.schema).json(path)
    per = F.inline("per_class").alias("class", "precision", "recall", "f1_score", "support")
    return rounded(back.select("model_id", "accuracy", "correct", "incorrect", per))


@query("S4_results_tree")
def _(spark, sf):
    """Tests, cells, folds and history of each model, written as one tree and read again."""
    path = gf.scratch_path(spark, "results")
    preds = spark_input(spark, sf, "models")
    tests = _model_metrics(spark, sf)
    cells = gf.outcome_counts(preds, by=["model_id"])
    folds = _folds(_model_counts(spark, sf))
    gaps = spark_input(spark, sf, "orders_nulls")
    missing = gf.missing_totals(gaps, gf.clean_missing(gaps))
    history = spark_input(spark, sf, "history")
    tree = gf.results_tree(tests, cells, folds, history, missing=missing,
                           settings={"folds": 5, "target": "event_type"}, max_epochs=30)
    gf.write_metrics(tree, path)
    back = spark.read.schema(tree.schema).json(path)
    return rounded(back.select(
        "model_id", "preparation.missing_before", "preparation.missing_after",
        F.col("preparation.settings")["target"].alias("target"),
        F.col("training.summary.total_epochs").alias("total_epochs"),
        F.size("training.rounds").alias("n_rounds"),
        F.col("test.metrics.accuracy").alias("accuracy"),
        F.size("test.cells").alias("n_cells"),
        F.aggregate("test.cells", F.lit(0).cast("bigint"), lambda a, c: a + c["n"]).alias("n_rows"),
        F.size("cross_validation.folds").alias("n_folds"),
        F.col("cross_validation.summary.mean_accuracy").alias("mean_accuracy"),
        F.size("verdict.recommendations").alias("n_recommendations")))


@query("S5_write_profile")
def _(spark, sf):
    path = gf.scratch_path(spark, "profile")
    gaps = spark_input(spark, sf, "orders_nulls")
    gf.write_profile({"missing": gf.missing_profile(gaps),
                      "classes": gf.class_distribution(gaps, "o_orderpriority")}, path)
    missing = gf.load_table(spark, f"{path}/missing", "csv").select(
        F.lit("missing").alias("part"), F.col("column_name").alias("name"),
        F.col("missing_count").cast("bigint").alias("count"),
        F.col("missing_percentage").alias("percentage"))
    classes = gf.load_table(spark, f"{path}/classes", "csv").select(
        F.lit("classes").alias("part"), F.col("class").alias("name"),
        F.col("count").cast("bigint").alias("count"), "percentage")
    return rounded(missing.unionByName(classes))


@query("S6_save_model")
def _(spark, sf):
    df, features = _flagged(spark, sf)
    path = gf.scratch_path(spark, "classifier")
    gf.save_model(gf.fit_classifier(df, features, kind="logreg", max_iter=10), path)
    return gf.predict(gf.load_model(path), df).select("l_orderkey", "label", "prediction")


# --- projections


@query("P1_split_xy")
def _(spark, sf):
    features, _ = gf.split_xy(spark_input(spark, sf, "part_cat"), "size_class")
    return features


@query("P2_drop_sparse_columns")
def _(spark, sf):
    return gf.drop_sparse_columns(spark_input(spark, sf, "orders_nulls"))


@query("P3_coerce_numeric")
def _(spark, sf):
    return gf.coerce_numeric(spark_input(spark, sf, "part_codes"))


@query("P4_cast_model_types")
def _(spark, sf):
    out = gf.cast_model_types(lineitem(spark, sf), PRICES, "l_linenumber")
    return out.select(*[F.col(c).cast("double").alias(c) for c in PRICES], "l_linenumber")


@query("P5_iqr_cap")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls")
    return gaps.select("o_orderkey", iqr_cap(F.col("o_totalprice"), 100000.0, 400000.0)
                       .alias("capped"))


def _probabilities(spark, sf) -> DataFrame:
    df = spark_input(spark, sf, "probabilities")
    return df.select("event_id", "label",
                     F.array(*[f"p{i}" for i in range(5)]).alias("probability"))


@query("P6_prob_to_label")
def _(spark, sf):
    return gf.prob_to_label(_probabilities(spark, sf), "probability").select(
        "event_id", "prediction")


@query("P6_prob_to_label_binary")
def _(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", (F.col("value") / (F.col("value") + 35)).alias("p"))
    return gf.prob_to_label(df, "p").select("event_id", "prediction")


@query("P7_prediction_rows")
def _(spark, sf):
    out = gf.prediction_rows(spark_input(spark, sf, "predictions"))
    return out.groupBy("true", "predicted", "correct").agg(F.count("*").alias("n"))


@query("P8_decode_label")
def _(spark, sf):
    out = gf.decode_label(spark_input(spark, sf, "predictions"), CLASSES)
    return out.select("event_id", "class")


# --- profiling


@query("A1_dataset_info")
def _(spark, sf):
    return gf.dataset_info(table(spark, sf, "customer"), "c_mktsegment")


@query("A2_missing_profile")
def _(spark, sf):
    return rounded(gf.missing_profile(spark_input(spark, sf, "orders_nulls")))


@query("A3_duplicate_profile")
def _(spark, sf):
    return rounded(gf.duplicate_profile(spark_input(spark, sf, "orders_dups")))


@query("A3_duplicate_profile_filtered")
def _(spark, sf):
    return rounded(gf.duplicate_profile(spark_input(spark, sf, "orders_dups"), suspect_limit=0))


@query("A4_quartiles_wide")
def _(spark, sf):
    out = gf.numeric_summary(spark_input(spark, sf, "lineitem_wide"))
    return rounded(out.select("column_name", "count", "min", "p25", "p50", "p75", "max"), 5)


@query("A4_numeric_summary")
def _(spark, sf):
    out = gf.numeric_summary(lineitem(spark, sf), [*PRICES, "l_linenumber"])
    return rounded(out.drop("skewness", "kurtosis"), 5)


@query("A5_shape_moments")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls")
    return rounded(gf.shape_moments(gaps, ["o_custkey", "o_totalprice", "no_price"]))


@query("A5_shape_moments_drop")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls")
    return rounded(gf.shape_moments(gaps, ["o_custkey", "o_totalprice", "half_price"], "drop"))


@query("A6_categorical_summary")
def _(spark, sf):
    return gf.categorical_summary(spark_input(spark, sf, "part_cat"))


@query("A7_target_summary")
def _(spark, sf):
    return gf.target_summary(table(spark, sf, "customer"), "c_mktsegment")


@query("A7_target_summary_numeric")
def _(spark, sf):
    return rounded(gf.target_summary(table(spark, sf, "customer"), "c_acctbal"), 5)


@query("A8_iqr_bounds")
def _(spark, sf):
    return rounded(gf.iqr_bounds(table(spark, sf, "events"), ["value", "user_id"]))


@query("A9_class_distribution")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls")
    return rounded(gf.class_distribution(gaps, "o_orderpriority"))


@query("A10_imbalance_ratio")
def _(spark, sf):
    return rounded(gf.imbalance_ratio(table(spark, sf, "documents"), "lang"))


def _correlations(spark, sf) -> DataFrame:
    return gf.correlation_matrix(spark_input(spark, sf, "lineitem_const"), [*PRICES, "k"])


@query("A11_correlation_matrix")
def _(spark, sf):
    return rounded(_correlations(spark, sf).select("a", "b", "corr"))


@query("A11_correlation_pairwise")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls")
    cols = ["o_orderkey", "o_custkey", "o_totalprice", "half_price", "no_price"]
    return rounded(gf.correlation_matrix(gaps, cols).select("a", "b", "corr"))


WIDE = [f"x{i}" for i in range(1, 23) if i not in (16, 17)]


@query("A11_correlation_wide")
def _(spark, sf):
    """Twenty columns, with gaps, constant and empty ones: sums of all products."""
    wide = spark_input(spark, sf, "lineitem_wide")
    return rounded(gf.correlation_matrix(wide, WIDE).select("a", "b", "corr"))


@query("A12_top_correlations")
def _(spark, sf):
    return rounded(gf.top_correlations(_correlations(spark, sf)))


@query("A13_correlation_lower_triangle")
def _(spark, sf):
    return rounded(gf.correlation_lower_triangle(_correlations(spark, sf)))


@query("A14_histogram")
def _(spark, sf):
    cols = ["l_extendedprice", "l_quantity", "k"]
    return rounded(gf.histogram(spark_input(spark, sf, "lineitem_const"), cols))


@query("A15_density")
def _(spark, sf):
    return rounded(gf.density(table(spark, sf, "events"), "value"), 8)


@query("A15_density_columns")
def _(spark, sf):
    return rounded(gf.density_columns(lineitem(spark, sf), [*PRICES, "l_partkey"]), 9)


@query("A16_box_stats")
def _(spark, sf):
    return rounded(gf.box_stats(table(spark, sf, "events"), ["value", "user_id"]))


@query("A17_scaling_advice")
def _(spark, sf):
    return rounded(gf.scaling_advice(lineitem(spark, sf), PRICES))


@query("A18_encoding_advice")
def _(spark, sf):
    return gf.encoding_advice(spark_input(spark, sf, "part_cat"))


@query("A19_missing_totals")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls")
    return gf.missing_totals(gaps, gf.clean_missing(gaps, "o_orderpriority"))


# --- cleaning


@query("T1_impute_median")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls").select("o_orderkey", "o_totalprice", "half_price")
    return rounded(gf.impute_median(gaps, ["o_totalprice", "half_price"]))


@query("T2_impute_mode")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls").select("o_orderkey", "o_orderpriority")
    return gf.impute_mode(gaps, ["o_orderpriority"])


@query("T3_clean_missing")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls")
    return rounded(gf.clean_missing(gaps, "o_orderpriority"))


@query("T4_drop_duplicates")
def _(spark, sf):
    return gf.drop_duplicates(spark_input(spark, sf, "orders_dups"))


@query("T4_drop_duplicates_filtered")
def _(spark, sf):
    return gf.drop_duplicates(spark_input(spark, sf, "orders_dups"), suspect_limit=0)


@query("T5_cap_outliers")
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "value")
    return rounded(gf.cap_outliers(events, ["value"]))


@query("T5_cap_zero_iqr")
def _(spark, sf):
    return rounded(gf.cap_outliers(spark_input(spark, sf, "sparse_count"), ["hits"]))


@query("T6_encode_binary")
def _(spark, sf):
    df = spark_input(spark, sf, "part_cat").select("p_partkey", "size_class")
    return gf.encode_binary(df, ["size_class"])


def _as_int(df: DataFrame) -> DataFrame:
    return df.select(*[
        (ref(f.name).cast("int") if isinstance(f.dataType, T.BooleanType) else ref(f.name))
        .alias(f.name) for f in df.schema.fields])


@query("T7_encode_onehot")
def _(spark, sf):
    df = spark_input(spark, sf, "part_cat").select("p_partkey", "p_type")
    return _as_int(gf.encode_onehot(df, ["p_type"]))


@query("T8_encode_frequency")
def _(spark, sf):
    df = spark_input(spark, sf, "part_cat").select("p_partkey", "p_brand")
    return rounded(gf.encode_frequency(df, ["p_brand"]))


@query("T8_encode_frequency_shuffled")
def _(spark, sf):
    # The path for value tables too large to broadcast.
    df = spark_input(spark, sf, "part_cat").select("p_partkey", "p_brand")
    return rounded(gf.encode_frequency(df, ["p_brand"], broadcast_bytes=0))


@query("T8_encode_frequency_cold")
def _(spark, sf):
    """Values that are too many to broadcast and each too rare to be hot."""
    df = lineitem(spark, sf).select("l_linenumber", F.col("l_orderkey").cast("string").alias("k"))
    return rounded(gf.encode_frequency(df, ["k"], broadcast_bytes=0), 9)


@query("T9_encode_categoricals")
def _(spark, sf):
    return rounded(_as_int(gf.encode_categoricals(spark_input(spark, sf, "part_cat"))))


@query("T10_standard_scale")
def _(spark, sf):
    df = spark_input(spark, sf, "lineitem_const")
    scaled = gf.standard_scale(df.withColumn("price", F.col("l_extendedprice")),
                               ["l_quantity", "l_extendedprice", "k"])
    return rounded(scaled.select("price", "l_quantity", "l_extendedprice", "k"))


@query("T11_encode_target")
def _(spark, sf):
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return gf.encode_target(df, "c_mktsegment")


@query("T11_encode_dictionary")
def _(spark, sf):
    """Every customer's name is a class of its own."""
    df = table(spark, sf, "customer").select("c_custkey", "c_name")
    known = gf.class_dictionary(df, "c_name", rows_per_range=100)
    coded = gf.encode_target(df, "c_name", dictionary=known)
    return gf.decode_label(coded, known, "label", "name").drop("c_name")


@query("T12_prepare")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls")
    ready = gf.prepare(gaps, "o_orderpriority", key="o_orderkey", exclude=["o_orderkey"])
    return rounded(_as_int(ready.df.drop("__gf_row")))


@query("T12_prepare_on_train")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls")
    ready = gf.prepare(gaps, "o_orderpriority", fit_on="train", key="o_orderkey",
                       exclude=["o_orderkey"])
    return rounded(_as_int(ready.df.drop("__gf_row")))


@query("T12_transform_stored")
def _(spark, sf):
    gaps = spark_input(spark, sf, "orders_nulls")
    ready = gf.prepare(gaps, "o_orderpriority", key="o_orderkey", exclude=["o_orderkey"])
    path = gf.scratch_path(spark, "preparation")
    gf.save_preparation(ready, path)
    return rounded(_as_int(gf.transform(gaps, gf.load_preparation(spark, path))))


# --- splits


@query("D1_stratified_split")
def _(spark, sf):
    return _split_orders(spark, sf)


@query("D1_stratified_split_narrowed")
def _(spark, sf):
    """Cutoffs searched in key prefixes, as for more rows than can be ranked at once."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return gf.stratified_split(orders, "o_orderpriority", key="o_orderkey", rankable_rows=100)


@query("D1_stratified_split_imbalanced")
def _(spark, sf):
    return gf.stratified_split(table(spark, sf, "labels"), "quality", key="doc_id")


@query("D2_split_report")
def _(spark, sf):
    return rounded(gf.split_report(_split_orders(spark, sf), "o_orderpriority"))


@query("D3_train_full")
def _(spark, sf):
    return gf.train_full(_split_orders(spark, sf))


@query("D4_kfold_assign")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return gf.kfold_assign(orders, key="o_orderkey")


@query("D4_kfold_assign_narrowed")
def _(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey")
    return gf.kfold_assign(orders, key="o_orderkey", rankable_rows=100)


# --- models


def _flagged(spark, sf) -> tuple[DataFrame, list[str]]:
    df = gf.encode_target(lineitem(spark, sf), "l_returnflag")
    return df.select("l_orderkey", *PRICES, "label"), PRICES


def _vectors(spark, sf) -> tuple[DataFrame, list[str]]:
    df = table(spark, sf, "embeddings")
    width = df.select(F.size("embedding").alias("n")).first()["n"]
    names = [f"e{i}" for i in range(width)]
    cols = [F.col("embedding")[i].alias(n) for i, n in enumerate(names)]
    return df.select("vec_id", *cols, "label"), names


@query("M1_fit_classifier")
def _(spark, sf):
    df, features = _vectors(spark, sf)
    fitted = gf.fit_classifier(df, features, max_iter=40)
    return gf.predict(fitted, df).select("vec_id", "label", "prediction")


@query("M1_fit_logistic")
def _(spark, sf):
    df, features = _flagged(spark, sf)
    fitted = gf.fit_classifier(df, features, kind="logreg", max_iter=20)
    return gf.accuracy(gf.predict(fitted, df))


@query("M2_fit_early_stopping")
def _(spark, sf):
    df, features = _vectors(spark, sf)
    rows = gf.stratified_split(df, "label", key="vec_id")
    _, history = gf.fit_early_stopping(
        rows.where("split = 'train'"), rows.where("split = 'val'"), features, rounds=4, patience=2)
    return history


# A logistic fit with one indicator per group and no penalty reproduces the class shares of each
# group, which SQL can state.
SATURATED = {"kind": "logreg", "reg": 0.0, "tol": 1e-12, "max_iter": 300}


def _grouped_orders(spark, sf) -> tuple[DataFrame, list[str]]:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    coded = gf.encode_target(orders, "o_orderpriority")
    marks = [(F.col("o_orderstatus") == v).cast("double").alias(f"is_{v}") for v in "OP"]
    return coded.select("o_orderkey", "o_orderstatus", "label", *marks), ["is_O", "is_P"]


def _group_shares(scored: DataFrame) -> DataFrame:
    """A row per group and class: its probability times the size of the group, in whole rows."""
    one = scored.groupBy("o_orderstatus").agg(F.max("probability").alias("p"), F.count("*").alias("n"))
    cells = one.select("o_orderstatus", "n", F.posexplode("p").alias("class", "share"))
    return cells.select("o_orderstatus", "class", F.round(F.col("share") * F.col("n")).cast("long").alias("n"))


@query("M1_fit_saturated")
def _(spark, sf):
    df, features = _grouped_orders(spark, sf)
    fitted = gf.fit_classifier(df, features, **SATURATED)
    return gf.predict(fitted, df).groupBy("o_orderstatus").agg(
        F.count("*").alias("n"), F.count_if(F.col("prediction") == F.col("label")).alias("hits"))


@query("M5_predict_saturated")
def _(spark, sf):
    df, features = _grouped_orders(spark, sf)
    return _group_shares(gf.predict(gf.fit_classifier(df, features, **SATURATED), df))


@query("S6_reload_saturated")
def _(spark, sf):
    df, features = _grouped_orders(spark, sf)
    path = gf.scratch_path(spark, "classifier")
    gf.save_model(gf.fit_classifier(df, features, **SATURATED), path)
    return _group_shares(gf.predict(gf.load_model(path), df))


@query("M6_cross_validate_saturated")
def _(spark, sf):
    """Four orders in five have their status as class, so the guess of a group is never tied."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", F.when(
        F.col("o_orderpriority") == "5-LOW", "X").otherwise(F.col("o_orderstatus")).alias("kind"))
    marks = {f"is_{v}": (F.col("o_orderstatus") == v).cast("double") for v in "OP"}
    df = gf.encode_target(orders, "kind").withColumns(marks).select("o_orderkey", "label", *marks)
    folds = gf.cross_validate(gf.kfold_assign(df, key="o_orderkey"), list(marks), **SATURATED)
    return rounded(folds.select("fold", "accuracy", "recall"))


@query("M3_training_summary")
def _(spark, sf):
    return rounded(gf.training_summary(spark_input(spark, sf, "history"), max_epochs=30))


@query("M4_loss_gap")
def _(spark, sf):
    return rounded(gf.loss_gap(spark_input(spark, sf, "history")))


@query("M5_predict")
def _(spark, sf):
    df, features = _flagged(spark, sf)
    scored = gf.predict(gf.fit_classifier(df, features, kind="rf"), df)
    return scored.select("l_orderkey", "probability", "prediction")


@query("M6_cross_validate")
def _(spark, sf):
    df, features = _vectors(spark, sf)
    folds = gf.kfold_assign(df, key="vec_id")
    return gf.cross_validate(folds, features, kind="logreg", max_iter=10, parallelism=4)


def _model_counts(spark, sf) -> DataFrame:
    """The outcomes of every model and fold: the one pass over the predictions."""
    return gf.outcome_counts(spark_input(spark, sf, "models"), by=["model_id", "fold"])


def _folds(counts: DataFrame) -> DataFrame:
    m = gf.classification_metrics(counts, "t", "p", ["model_id", "fold"], count="n")
    return m.select("model_id", "fold", "accuracy", F.col("precision_weighted").alias("precision"),
                    F.col("recall_weighted").alias("recall"), F.col("f1_weighted").alias("f1"))


@query("M7_cv_summary")
def _(spark, sf):
    return rounded(gf.cv_summary(_folds(_model_counts(spark, sf))))


# --- evaluation


@query("E1_confusion_matrix")
def _(spark, sf):
    return gf.confusion_matrix(spark_input(spark, sf, "predictions"))


@query("E2_accuracy")
def _(spark, sf):
    return rounded(gf.accuracy(spark_input(spark, sf, "predictions")))


@query("E3_weighted_prf")
def _(spark, sf):
    return rounded(gf.weighted_prf(spark_input(spark, sf, "predictions_gap")))


@query("E4_per_class_metrics")
def _(spark, sf):
    return rounded(gf.per_class_metrics(spark_input(spark, sf, "predictions_gap")))


@query("E5_classification_report")
def _(spark, sf):
    return rounded(gf.classification_report(spark_input(spark, sf, "predictions_gap")))


@query("E6_confusion_normalized")
def _(spark, sf):
    return rounded(gf.confusion_normalized(spark_input(spark, sf, "predictions")))


@query("E7_error_matrix")
def _(spark, sf):
    return rounded(gf.error_matrix(spark_input(spark, sf, "predictions")))


@query("E1_confusion_cells")
def _(spark, sf):
    return gf.confusion_matrix(spark_input(spark, sf, "predictions"), sparse=True)


@query("E6_confusion_shares")
def _(spark, sf):
    return rounded(gf.confusion_normalized(spark_input(spark, sf, "predictions"), sparse=True))


@query("E7_error_shares")
def _(spark, sf):
    return rounded(gf.error_matrix(spark_input(spark, sf, "predictions"), sparse=True))


@query("E8_top_error")
def _(spark, sf):
    return rounded(gf.top_error(spark_input(spark, sf, "predictions")))


@query("E9_prediction_distribution")
def _(spark, sf):
    return rounded(gf.prediction_distribution(spark_input(spark, sf, "predictions")))


@query("E10_class_accuracy_band")
def _(spark, sf):
    return rounded(gf.class_accuracy_band(spark_input(spark, sf, "predictions")))


@query("E11_roc_curve")
def _(spark, sf):
    return rounded(gf.roc_curve(spark_input(spark, sf, "predictions_binary")), 9)


@query("E12_roc_curve_ovr")
def _(spark, sf):
    return rounded(gf.roc_curve_ovr(_probabilities(spark, sf)), 9)


@query("E11_roc_curve_ranges")
def _(spark, sf):
    scored = spark_input(spark, sf, "predictions_binary")
    return rounded(gf.roc_curve(scored, rows_per_bucket=20), 9)


@query("E12_roc_curve_ovr_ranges")
def _(spark, sf):
    return rounded(gf.roc_curve_ovr(_probabilities(spark, sf), rows_per_bucket=1_000), 9)


@query("E13_auc")
def _(spark, sf):
    return rounded(gf.auc(gf.roc_curve(spark_input(spark, sf, "predictions_binary"))))


@query("E13_auc_ovr")
def _(spark, sf):
    return rounded(gf.auc(gf.roc_curve_ovr(_probabilities(spark, sf))))


@query("E14_auc_from_labels")
def _(spark, sf):
    return rounded(gf.auc_from_labels(spark_input(spark, sf, "predictions_binary")))


@query("E14_macro_auc")
def _(spark, sf):
    return rounded(gf.macro_auc(gf.roc_curve_ovr(_probabilities(spark, sf))))


# --- verdicts


def _model_metrics(spark, sf) -> DataFrame:
    return _per_model(_model_counts(spark, sf))


def _per_model(counts: DataFrame) -> DataFrame:
    return gf.classification_metrics(counts, "t", "p", ["model_id"], count="n")


def _joined(df: DataFrame) -> DataFrame:
    """Text arrays as one text, to compare across engines."""
    return df.select(*[
        (F.array_join(ref(f.name), " | ") if isinstance(f.dataType, T.ArrayType) else ref(f.name))
        .alias(f.name) for f in df.schema.fields])


@query("V1_strengths")
def _(spark, sf):
    return _joined(gf.strengths(_model_metrics(spark, sf)).select("model_id", "strengths"))


@query("V2_weaknesses")
def _(spark, sf):
    return _joined(gf.weaknesses(_model_metrics(spark, sf)).select("model_id", "weaknesses"))


def _stored_counts(spark, sf) -> DataFrame:
    """The counts written once: the two sides of the join below would scan twice."""
    return gf.materialize(_model_counts(spark, sf), "outcomes")


def _scored_models(spark, sf) -> DataFrame:
    counts = _stored_counts(spark, sf)
    cv = gf.cv_summary(_folds(counts)).select("model_id", "std_accuracy")
    return _per_model(counts).join(cv, "model_id", "left")


@query("V3_recommendations")
def _(spark, sf):
    out = gf.recommendations(_scored_models(spark, sf))
    return _joined(out.select("model_id", "recommendations"))


@query("V4_stability_band")
def _(spark, sf):
    out = gf.stability_band(gf.cv_summary(_folds(_model_counts(spark, sf))))
    return out.select("model_id", "stability")


@query("V5_conclusion_grade")
def _(spark, sf):
    return gf.conclusion_grade(_model_metrics(spark, sf)).select("model_id", "conclusion")


@query("V6_scorecard")
def _(spark, sf):
    counts = _stored_counts(spark, sf)
    card = gf.scorecard(_per_model(counts), gf.cv_summary(_folds(counts)))
    return rounded(_joined(card))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Raw orders to weighted test metrics of a fitted classifier."""
    gaps = spark_input(spark, sf, "orders_nulls")
    ready = gf.prepare(gaps, "o_orderpriority", key="o_orderkey", exclude=["o_orderkey"])
    _, scored = gf.train_and_test(ready, hidden=(16, 8), max_iter=20)
    return gf.weighted_prf(scored)


QUERIES["T12_prepare_and_fit"] = flagship
