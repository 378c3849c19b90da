"""Session helpers.

Library operators never create or configure a session: they take DataFrames
and return DataFrames. These helpers exist for tests, the bench and the driver
entry point, and for the one piece of session state operators need — the
shared checkpoint folder named by ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  app: str = "cohortkit") -> SparkSession:
    """A local session configured the way tests and the bench expect.

    AQE stays on (partition coalescing, skew-join splitting, runtime
    broadcast conversion), the UI stays off, timestamps are UTC.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, object
    store) and is used as is. Only where nothing is configured — local tests —
    a fresh scratch folder is created and registered.
    """
    sc = spark.sparkContext
    current = sc.getConf().get(CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder shared by all executors "
                               "(a machine-local folder would not survive executor loss)")
        current = tempfile.mkdtemp(prefix="cohortkit-ckpt-",
                                   dir=os.environ.get("TMPDIR", "/tmp"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current
