"""lumenreg — Spark-native regression analytics over retail sales tables.

Load sales rows (CSV, catalog table or parquet), normalise and clean them,
split them repeatably, assemble features, tune linear / tree / boosted-tree
regressors by cross-validation or a held-out split, score in bulk, publish
predictions as SQL views and report metrics as DataFrames.

Every heavy step is a Spark job (DataFrame / SQL / MLlib); the driver only
ever sees bounded metadata (moment matrices, candidate metrics, model
parameters).
"""

from lumenreg.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
