from gaugeframe.plans.assessment import (
    Trained,
    cross_validation,
    evaluate,
    report,
    results_tree,
    train_and_test,
    train_with_stopping,
)
from gaugeframe.plans.exploration import explore
from gaugeframe.plans.preparation import Prepared, prepare
from gaugeframe.plans.stored import Preparation, load_preparation, save_preparation, transform

__all__ = ["Preparation", "Prepared", "Trained", "cross_validation", "evaluate", "explore",
           "load_preparation", "prepare", "report", "results_tree", "save_preparation",
           "train_and_test", "train_with_stopping", "transform"]
