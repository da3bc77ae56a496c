from tabprep.plans.lifecycles import (
    Outcome,
    analyze,
    forest_predict,
    logistic_predict,
    network_predict,
    probabilities,
    tune_and_predict,
)

__all__ = [
    "Outcome",
    "analyze",
    "forest_predict",
    "logistic_predict",
    "network_predict",
    "probabilities",
    "tune_and_predict",
]
