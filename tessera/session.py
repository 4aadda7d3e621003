"""SparkSession construction and the shared scratch location.

Every job that materialises intermediate data (landed files, versioned
tables, streaming checkpoints) writes below the folder the cluster names in
``spark.checkpoint.dir``.  Only when that setting is absent (local tests,
benchmarks) do we pick a folder ourselves.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"
_LOCAL_FALLBACK: dict[str, str] = {}  # application id -> folder chosen in local mode
_SHIPPED: set[str] = set()  # application ids whose workers have the package


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera") -> SparkSession:
    """Session tuned for this library: UTC, ANSI, AQE with skew handling.

    ``shuffle_partitions`` is the *initial* partition count; AQE coalesces it at
    runtime, so on a cluster it should be sized for the largest shuffle
    (roughly input bytes / 128 MB), not for the smallest.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    if shuffle_partitions is None and (master or "").startswith("local"):
        shuffle_partitions = os.cpu_count() or 8
    b = (b.config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.ansi.enabled", "true")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.files.maxPartitionBytes", str(128 * 1024 * 1024))
         .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(128 * 1024 * 1024))
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "8g")))
    if shuffle_partitions is not None:
        # on a cluster leave the deployment's value; AQE coalesces it at runtime
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shuffle_partitions_for(shuffle_bytes: int, target_bytes: int = 256 * 1024 * 1024,
                           minimum: int = 200) -> int:
    """Initial shuffle partition count for a shuffle of ``shuffle_bytes``.

    Every reduce task should hold about ``target_bytes`` so it sorts / hashes
    in executor memory without heavy spilling; AQE then coalesces partitions
    that turn out smaller.  E.g. the fact's de-duplication shuffle at ~20 TB
    -> ~80,000 partitions.
    """
    return max(minimum, -(-int(shuffle_bytes) // int(target_bytes)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    Only a local-mode session (tests, benchmarks) may fall back to a private
    temporary folder; on a cluster a machine-local folder would not survive
    the loss of the machine, so a missing setting is an error there.
    """
    sc = spark.sparkContext
    base = (spark.conf.get(_CHECKPOINT_KEY, None) or sc.getConf().get(_CHECKPOINT_KEY, None)
            or _LOCAL_FALLBACK.get(sc.applicationId))
    if not base:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS / object "
                               "store) before running tessera jobs on a cluster")
        base = tempfile.mkdtemp(prefix="tessera-ckpt-")
        _LOCAL_FALLBACK[sc.applicationId] = base
        if _is_runtime_settable(spark):
            spark.conf.set(_CHECKPOINT_KEY, base)
    if sc.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def _is_runtime_settable(spark: SparkSession) -> bool:
    try:
        return spark.conf.isModifiable(_CHECKPOINT_KEY)
    except Exception:  # noqa: BLE001 - older/limited clients
        return False


def checkpoint_base(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Functions that run in workers are sent by name, so every machine needs the
    package; where it is installed or on PYTHONPATH this changes nothing.
    """
    app, here = spark.sparkContext.applicationId, os.path.dirname(os.path.abspath(__file__))
    if app in _SHIPPED or not os.path.isdir(here):  # inside an archive: shipped already
        return
    path = os.path.join(tempfile.mkdtemp(prefix="tessera-"), "tessera.zip")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(here):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                archive.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def _scratch_root(spark: SparkSession) -> str:
    return f"{checkpoint_base(spark).rstrip('/')}/tessera/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique folder of this application below the shared checkpoint location."""
    return f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def release_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folders, once no result that reads them is
    needed any more (results are lazy: write or collect them first)."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_scratch_root(spark))
    root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(root, True)
