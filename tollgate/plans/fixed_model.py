"""A small ensemble with given numbers, so that another engine can restate what a model gives.

Numbers are chosen, not fitted: every feature, both outcomes of every flag and both sides of every
threshold occur in the trees.
"""

from __future__ import annotations

from tollgate.operators.model import ScoringModel
from tollgate.schemas import MODEL_FEATURES

MODEL = ScoringModel(
    features=list(MODEL_FEATURES),
    means=[4.0, 0.5, 0.05, 0.25, 0.4],
    deviations=[3.0, 0.75, 0.04, 0.5, 0.0],
    coefficients=[0.45, -0.3, 0.8, 0.00005, 0.15],
    intercept=-0.35,
    trees=[
        {"left": [1, 3, 5, -1, -1, -1, -1], "right": [2, 4, 6, -1, -1, -1, -1], "feature": [2, 0, 4, -1, -1, -1, -1],
         "threshold": [0.06, 2.0, 0.5, 0.0, 0.0, 0.0, 0.0], "weight": [100.0, 60.0, 40.0, 35.0, 25.0, 30.0, 10.0],
         "value": [0.4, 0.25, 0.6, 0.1037, 0.3961, 0.5523, 0.9013]},
        {"left": [1, 3, -1, -1, -1], "right": [2, 4, -1, -1, -1], "feature": [0, 1, -1, -1, -1],
         "threshold": [3.0, 0.0, 0.0, 0.0, 0.0], "weight": [80.0, 50.0, 30.0, 40.0, 10.0], "value": [0.4, 0.3, 0.6979, 0.2019, 0.5017]},
        {"left": [1, -1, 3, -1, -1], "right": [2, -1, 4, -1, -1], "feature": [3, -1, 2, -1, -1],
         "threshold": [0.5, 0.0, 0.1, 0.0, 0.0], "weight": [64.0, 48.0, 16.0, 8.0, 8.0], "value": [0.3, 0.1531, 0.65, 0.4507, 0.8483]},
    ],
    importances=[0.35, 0.1, 0.35, 0.15, 0.05],
)
