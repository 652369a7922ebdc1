"""Feature assembly and the three MLlib regressors of the workflows."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor,
                                   LinearRegression)

from lumenreg.config import (FEATURE_COLS, FEATURES_COL, GBT_MAX_ITER, LABEL_COL,
                             LR_MAX_ITER, LR_REG_PARAM, TREE_MAX_BINS)


def assembler(input_cols: list[str] | None = None, output_col: str = FEATURES_COL,
              handle_invalid: str = "error") -> VectorAssembler:
    """Vector of the six inputs; ``handle_invalid='error'`` rejects NULL and NaN."""
    return VectorAssembler(inputCols=list(input_cols or FEATURE_COLS),
                           outputCol=output_col, handleInvalid=handle_invalid)


def linear(reg_param: float = LR_REG_PARAM, max_iter: int = LR_MAX_ITER,
           **kw) -> LinearRegression:
    return LinearRegression(featuresCol=FEATURES_COL, labelCol=LABEL_COL,
                            regParam=reg_param, maxIter=max_iter, **kw)


def tree(max_bins: int = TREE_MAX_BINS, max_depth: int = 5, seed: int = 1,
         **kw) -> DecisionTreeRegressor:
    return DecisionTreeRegressor(featuresCol=FEATURES_COL, labelCol=LABEL_COL,
                                 maxBins=max_bins, maxDepth=max_depth, seed=seed, **kw)


def boosted(max_bins: int = TREE_MAX_BINS, max_iter: int = GBT_MAX_ITER,
            seed: int = 1, **kw) -> GBTRegressor:
    return GBTRegressor(featuresCol=FEATURES_COL, labelCol=LABEL_COL,
                        maxBins=max_bins, maxIter=max_iter, seed=seed, **kw)


def pipeline(estimator, input_cols: list[str] | None = None) -> Pipeline:
    """assembler -> estimator, as in the workflows."""
    return Pipeline(stages=[assembler(input_cols), estimator])

