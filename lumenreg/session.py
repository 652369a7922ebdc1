"""Session helpers.

Shared scratch lives under the checkpoint directory that the cluster names in
``spark.checkpoint.dir``. Only on a local master, where all executors share the
driver's disk, is a private temporary folder made if that setting is absent;
elsewhere that is an error, raised by what needs the folder.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the workflows at scale. AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splitting covers a hot
# key holding a large share of rows.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "lumenreg",
                shuffle_partitions: int | None = None,
                extra_conf: dict | None = None) -> SparkSession:
    """Return the active session or build one with the library defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint dir; on a local master, set a private one if unset."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               f"executors share (master {sc.master})")
        configured = tempfile.mkdtemp(prefix="lumenreg-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_scratch: set[str] = set()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint directory.

    What is left of it when the program ends is removed then.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/lumenreg-scratch/{name}-{uuid.uuid4().hex}"
    _scratch.add(path)
    return path


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder made by :func:`scratch_dir`, on whatever file system it lies."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    _scratch.discard(path)


@atexit.register
def _remove_left_scratch() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        for path in sorted(_scratch):
            remove_scratch(spark, path)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written to the shared checkpoint directory, which cuts their lineage."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ensure_codegen_fields(spark: SparkSession, fields: int) -> None:
    """Raise whole-stage codegen's field limit to ``fields`` if it is lower.

    It is only ever raised, so workflows that run side by side in a session
    can't undo each other's setting.
    """
    if int(spark.conf.get("spark.sql.codegen.maxFields")) < fields:
        spark.conf.set("spark.sql.codegen.maxFields", str(fields))
