from gaugeframe.operators.clean import (
    cap_outliers,
    clean_missing,
    coerce_numeric,
    drop_duplicates,
    drop_sparse_columns,
    impute_median,
    impute_mode,
)
from gaugeframe.operators.distribution import (
    box_stats,
    correlation_lower_triangle,
    correlation_matrix,
    density,
    density_columns,
    histogram,
    top_correlations,
)
from gaugeframe.operators.encode import (
    class_dictionary,
    decode_label,
    encode_binary,
    encode_categoricals,
    encode_frequency,
    encode_onehot,
    encode_target,
    standard_scale,
)
from gaugeframe.operators.metrics import (
    accuracy,
    auc_from_labels,
    class_accuracy_band,
    classification_metrics,
    classification_report,
    confusion_matrix,
    confusion_normalized,
    error_matrix,
    outcome_counts,
    per_class_metrics,
    prediction_distribution,
    prediction_rows,
    prob_to_label,
    top_error,
    weighted_prf,
)
from gaugeframe.operators.model import (
    cast_model_types,
    cross_validate,
    fit_classifier,
    fit_early_stopping,
    predict,
    split_xy,
)
from gaugeframe.operators.profile import (
    categorical_summary,
    class_distribution,
    dataset_info,
    duplicate_profile,
    encoding_advice,
    imbalance_ratio,
    iqr_bounds,
    missing_profile,
    missing_totals,
    numeric_summary,
    scaling_advice,
    shape_moments,
    target_summary,
)
from gaugeframe.operators.roc import auc, macro_auc, roc_curve, roc_curve_ovr
from gaugeframe.operators.split import kfold_assign, split_report, stratified_split, train_full
from gaugeframe.operators.training import cv_summary, loss_gap, training_summary
from gaugeframe.operators.verdict import (
    conclusion_grade,
    recommendations,
    scorecard,
    stability_band,
    strengths,
    weaknesses,
)

__all__ = [name for name in dir() if not name.startswith("_")]
