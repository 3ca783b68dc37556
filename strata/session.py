"""Session construction and the shared scratch location."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every strata job relies on. ANSI stays on: ``cast`` fails fast and
# ``try_cast`` returns NULL, which is exactly the strict/lenient split the
# cleaning layer needs. UTC keeps date arithmetic identical on every executor.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Planning-time broadcast decisions use size estimates that, without CBO, are
    # upper bounds derived from file sizes; scale them for Parquet decompression so
    # a side is broadcast only when its in-memory size is safely under the limit.
    "spark.sql.sources.fileCompressionFactor": "4.0",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Files of checkpoints that nothing refers to any more are removed.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "strata", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with strata's defaults.

    On a cluster leave ``master`` as ``None`` so spark-submit decides, and size
    ``shuffle_partitions`` to roughly input-bytes / 128 MB (AQE coalesces the rest).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("WARN")
    except Exception:
        pass
    ensure_checkpoint_dir(spark)
    return spark


MIB = 1024 * 1024


def sized_conf(input_bytes: int, cores: int, max_split: int = 128 * MIB, min_split: int = MIB,
               shuffle_bytes: int = 256 * MIB) -> dict:
    """Split, row-group and shuffle sizes for ``input_bytes`` of input on ``cores``.

    Input splits aim at four per core, bounded to [1 MB, 128 MB]: tiny inputs still
    give every core work, big ones keep the usual 128 MB splits (and row groups for
    the layers written). Shuffle partitions: one per 256 MB of input, at least one
    per core; AQE coalesces the small ones and splits skewed ones at runtime.
    """
    split = max(min_split, min(max_split, input_bytes // max(1, cores * 4)))
    shuffle = max(cores, -(-input_bytes // shuffle_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.files.openCostInBytes": str(max(64 * 1024, min(4 * MIB, split // 4))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(split),
        "spark.hadoop.parquet.block.size": str(split),
        "spark.sql.shuffle.partitions": str(shuffle),
    }


def input_bytes(spark: SparkSession, paths) -> int:
    """Total size of the files under ``paths`` (listed, not read)."""
    total = 0
    for path in paths:
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
                      .selectExpr("sum(length) as b").first()["b"])
        total += int(files or 0)
    return total


def apply_sizes(spark: SparkSession, size: int) -> None:
    """Size the session's splits and shuffles for ``size`` bytes of input, unless the
    user has set them. Row-group size is a Hadoop setting of the running context."""
    sc = spark.sparkContext
    for key, value in sized_conf(size, sc.defaultParallelism).items():
        if key.startswith("spark.hadoop."):
            sc._jsc.hadoopConfiguration().set(key.removeprefix("spark.hadoop."), value)
        elif not sc.getConf().contains(key):
            spark.conf.set(key, value)


def is_local(spark: SparkSession) -> bool:
    """Driver and executors are one process (``local``, ``local[n]``): one machine's folder
    is everyone's. ``local-cluster`` runs executors of their own."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The folder named by ``spark.checkpoint.dir`` (or set on the context) is used as it is.
    Where nothing is configured a private folder is made, but only under a local master;
    on a cluster every executor would write to its own disk, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share "
                               f"(master is {sc.master})")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def layers_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for written layers: under ``spark.strata.layers.dir`` if that is set,
    else under the checkpoint folder."""
    root = spark.conf.get("spark.strata.layers.dir", None)
    return f"{root.rstrip('/')}/strata-{label}-{uuid.uuid4().hex[:12]}" if root else scratch_dir(spark, label)


def session_id(spark: SparkSession) -> str:
    """Identifier of the running application (stable for the session's lifetime)."""
    try:
        return spark.sparkContext.applicationId
    except Exception:
        return spark.conf.get("spark.app.id", None) or str(id(spark))


def scratch_dir(spark: SparkSession, label: str = "scratch") -> str:
    """A fresh, unique folder under the shared checkpoint location.

    Used for files a job writes and reads back (bronze round-trips, lineage cuts),
    so every executor sees them on a cluster. Writers create it.
    """
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/strata-{label}-{uuid.uuid4().hex[:12]}"
