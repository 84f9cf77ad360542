"""Session helpers: a local session for tests/bench and the shared scratch area.

Jobs never pick a machine-local folder on their own: scratch tables go under
the shared folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (a laptop, a unit test) is a temporary folder made and
registered as the checkpoint directory.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tierkit") -> SparkSession:
    """A local session configured the way the tests and the bench expect."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Small stages: let AQE coalesce down to ~cores tasks, not to one
        # (many partition values in one task = one file after another).
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "4k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only if none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect has no SparkContext
        sc = None
    if sc is not None:
        current = sc.getCheckpointDir()
        if current:
            return current.rstrip("/")
    master = spark.conf.get("spark.master", "") or (sc.master if sc is not None else "")
    if not master.startswith("local"):
        # On a cluster a temporary folder would be local to one machine.
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    # Unset in a local session (tests, a laptop): make one and register it.
    root = tempfile.mkdtemp(prefix="tierkit-ckpt-")
    if sc is None:
        return root
    sc.setCheckpointDir(root)  # later calls find it via getCheckpointDir()
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, never reused folder under the shared checkpoint folder."""
    return f"{checkpoint_root(spark)}/tierkit-scratch/{label}-{uuid.uuid4().hex}"
