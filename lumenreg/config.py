"""Fixed values of the sales workflows.

These must equal the values the original workflows use for results to
match, so they are stated plainly here, in their natural order.
"""

from __future__ import annotations

# --- fixed values: feature inputs, in vector order --------------------------
FEATURE_COLS = [
    "Pack",
    "BottleVolumeInMl",
    "StateBottleCost",
    "StateBottleRetail",
    "BottlesSold",
    "VolumeSoldInLitres",
]
# Target column before it is renamed to ``label``.
TARGET_COL = "SaleInDollars"
# Order of the seven selected sales columns.
SELECTED_COLS = [
    "Pack",
    "BottleVolumeInMl",
    "StateBottleCost",
    "StateBottleRetail",
    "BottlesSold",
    "SaleInDollars",
    "VolumeSoldInLitres",
]
# Integer columns cast to double before assembly.
CAST_TO_DOUBLE = ["Pack", "BottleVolumeInMl", "BottlesSold"]

# --- fixed values: raw CSV header -> cleaned header --------------------------
RAW_TO_CLEAN = {
    "Pack": "Pack",
    "Bottle Volume (ml)": "BottleVolumeInMl",
    "State Bottle Cost": "StateBottleCost",
    "State Bottle Retail": "StateBottleRetail",
    "Bottles Sold": "BottlesSold",
    "Sale (Dollars)": "SaleInDollars",
    "Volume Sold (Liters)": "VolumeSoldInLitres",
}

# --- fixed values: model and tuning settings of the four workflows ----------
LR_REG_PARAM = 0.3
LR_MAX_ITER = 10
LR_GRID = {"regParam": [0.3, 0.1, 0.01], "maxIter": [10, 5]}
LR_CV_FOLDS = 10
TVS_TRAIN_RATIO = 0.8
TREE_MAX_BINS = 77582
TREE_CV_FOLDS = 5
GBT_MAX_ITER = 2
GBT_GRID = {
    "maxDepth": [2, 3],
    "minInfoGain": [0.0, 0.1, 0.2, 0.3],
    "stepSize": [0.05, 0.1, 0.2, 0.4],
}
TRAIN_TEST_WEIGHTS = [0.7, 0.3]

# --- fixed values: prediction view names of the linear workflows -----------
VIEW_NAMES = {
    "lr_cv": "regressionPredictionsCV",
    "lr_tvs": "regressionPredictionsTVS",
}

# Our own names: the tree workflows get views of their own, so that none overwrites another.
VIEW_NAMES |= {"dt_cv": "regressionPredictionsDT", "gbt_tvs": "regressionPredictionsGBT"}

LABEL_COL = "label"
TRUE_LABEL_COL = "trueLabel"
PREDICTION_COL = "prediction"
FEATURES_COL = "features"
