"""Session construction and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI casts raise instead of truncating, all
# timestamps are UTC, AQE re-plans joins / partition counts from runtime
# statistics and splits skewed join partitions, and partition overwrites only
# replace the partitions a write touches.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Reliable checkpoints (partition replacement) are removed once unused.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, app_name: str = "pluvia",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  input_bytes: int | None = None) -> SparkSession:
    """Create (or reuse) a session with :data:`BASE_CONF` applied.

    On a cluster leave ``master`` unset (the launcher decides) and pass the
    job's ``input_bytes`` so shuffles start at a reducer size that fits
    executor memory (:func:`scale_settings`); AQE coalesces at run time.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if input_bytes:
        conf.update(scale_settings(input_bytes))
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in conf.items():
        if not key.startswith(("spark.ui", "spark.driver", "spark.cleaner")):
            try:
                spark.conf.set(key, value)
            except Exception:  # static conf already fixed by the launcher
                pass
    return spark


def scale_settings(input_bytes: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Shuffle sizing for a job reading ``input_bytes``.

    The initial shuffle partition count is the input over ``target_partition_bytes``
    (100 TB at 256 MB: 409,600), so a reducer's share stays the same at every size;
    AQE then coalesces small ones and splits skewed join partitions.
    """
    n = max(1, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(128 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def app_id(spark: SparkSession) -> str:
    """Identifier of the running application (classic or Connect session)."""
    try:
        return spark.conf.get("spark.app.id")
    except Exception:  # noqa: BLE001
        return str(id(spark))


def _context(spark: SparkSession):
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect has no SparkContext
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a ``local`` session without one gets a private folder (its executors are this
    process); on a cluster a missing setting raises, since no local folder is shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not root and sc is not None:
        root = sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="pluvia-ckpt-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc is not None:
        sc.setCheckpointDir(root)
    return root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder under the checkpoint root."""
    root = checkpoint_root(spark)
    return os.path.join(root, f"{name}-{uuid.uuid4().hex[:12]}")
