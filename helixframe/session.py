"""Session construction and cluster-facing settings.

The library never decides cluster sizing on its own: it reads what the
session already has and only fills gaps (local tests, benches).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: ANSI semantics stay on (default in 4.x),
# AQE re-plans joins/aggregations from runtime statistics, skewed shuffle
# partitions are split, and timestamps are UTC so oracle comparisons agree.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    # AQE turns a sort-merge join into a shuffled hash join when every
    # post-shuffle partition of the build side is below this size (checked
    # per partition at runtime, so it stays safe at any scale).
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Broadcast only behind a size check: at plan time Spark compares the
    # (conservative, file-statistics based) size estimate with 10 MB; at run
    # time AQE re-checks the *measured* shuffle output of each join side and
    # converts to a broadcast join only under its own threshold.  Anything
    # larger stays a shuffle join.  Explicit broadcast() hints are used only
    # on lookups bounded by construction (nodes, cohorts, one-row models).
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.session.timeZone": "UTC",
    # checkpointed lookups and model rounds are removed from the shared
    # folder once no plan references them any more
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "helixframe",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster ``master`` stays ``None`` and the launcher decides; tests
    and the bench pass ``local[N]``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the deployment (shared storage).  Only
    a local-mode session with nothing configured gets a private scratch
    folder, as in tests.
    """
    sc = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        path = tempfile.mkdtemp(prefix="helixframe-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def local_cpus(default: int = 8) -> int:
    try:
        return int(os.environ.get("BENCH_CPUS", default))
    except ValueError:
        return default
