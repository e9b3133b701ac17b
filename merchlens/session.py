"""SparkSession defaults and shared-folder helpers."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings the engine relies on for correct results (UTC calendar fields,
# ANSI arithmetic) and for scale (AQE: runtime broadcast choice by measured
# size, partition coalescing, skew-join splitting).
ENGINE_CONF: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    master: str | None = None,
    app_name: str = "merchlens",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the engine defaults.

    ``master`` is only set when given, so on a cluster the launcher decides.
    The UI stays off: nothing here needs a web server.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    if master and master.startswith("local") and "spark.checkpoint.dir" not in conf:
        import tempfile

        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="merchlens-ckpt-")
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in ENGINE_CONF.items():
        spark.conf.set(k, v)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only a local-mode session (tests, single machine)
    may fall back to a fresh folder of its own; on a cluster an unset
    checkpoint dir is an error, since a machine-local folder is not shared.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        import tempfile

        d = tempfile.mkdtemp(prefix="merchlens-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return (sc.getCheckpointDir() or d).rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared folder for a written table."""
    return f"{shared_dir(spark)}/merchlens/{name}-{uuid.uuid4().hex[:12]}"


def clear_scratch(spark: SparkSession) -> None:
    """Deletes the tables that this session has written for its own use. Call it when no frame that reads them is needed any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/merchlens")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    return shared_dir(spark)


def at_once(spark: SparkSession, steps: Sequence[Callable]) -> list:
    """Runs steps that don't need each other, each in a thread with the caller's job properties: the last tasks and the planning of one leave cores
    to the others. Returns their results in order; an error is raised when all have ended."""
    with ThreadPoolExecutor(max(1, len(steps))) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(step)) for step in steps]]


def env_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default


def cluster_conf(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Sizing for a cluster run: enough shuffle partitions that each holds
    about ``target_partition_bytes`` of the input (at least 3 waves of the
    cores), file splits of the same size, and AQE free to coalesce small
    partitions or split skewed ones at run time. Pass the result as
    ``build_session(extra=...)`` or ``spark-submit --conf``."""
    parts = max(3 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
