"""SparkSession helpers.

Library code never creates a session: operators use the one they are given.
These helpers are for tests, the bench and command-line runs.
"""

from __future__ import annotations

import contextlib
import os
import re
import tempfile
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Settings every tillroll job assumes. AQE re-plans joins from measured sizes
# (runtime broadcast with sort-merge fallback), coalesces small shuffle
# partitions and splits skewed ones.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot order's rows even where the aggregation above then needs a
    # shuffle of its own, which AQE declines by default
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # broadcast decisions stay size-checked (static estimate and AQE's measured
    # size); the bound is raised from 10 MB to 64 MB, still far below executor memory
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app: str = "tillroll", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
               .config("spark.driver.memory", "16g"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder (``spark.checkpoint.dir``).

    On a cluster the folder is set by the operator and only read here; without
    it this raises, because a machine-local folder would not be visible to the
    other executors. Only in local mode (tests, the bench) is a scratch folder
    chosen when unset.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    current = tempfile.mkdtemp(prefix="tillroll-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


#: Bytes of stored input for each shuffle partition of a sized session.
PARTITION_BYTES = 8 << 20
#: Most bytes that one task of a sized session is dealt: of a scan, of partitions that AQE
#: puts together (Spark's own 64 MB are millions of narrow rows, and a task sorts and groups
#: all of its rows at once), and of a partition of a join before it counts as skewed.
TASK_BYTES = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 32 << 20,
}


def _bytes(setting: str) -> int:
    """A size as Spark's settings write it: ``64m``, ``64MB``, ``67108864b``, ``67108864``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)i?b?", setting.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def stored_bytes(spark: SparkSession, paths: Iterable[str]) -> int:
    """Bytes of the files below those of the ``paths`` that exist, in whatever store they are."""
    total = 0
    for path in paths:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.exists(p):
            total += fs.getContentSummary(p).getLength()
    return total


def sized_session(spark: SparkSession, paths: Iterable[str]) -> SparkSession:
    """A session with the settings of ``spark`` whose tasks stay as small as they are, however large the input at ``paths`` is.

    It has one shuffle partition for each ``PARTITION_BYTES`` of input (or ``spark``'s number,
    if that is more) and deals a task at most ``TASK_BYTES`` (or ``spark``'s sizes, where smaller).
    ``spark`` itself stays as it is."""
    own = spark.newSession()
    has = own.conf.getAll
    for key, value in spark.conf.getAll.items():
        if has.get(key) != value:
            with contextlib.suppress(AnalysisException):  # settings of the whole application hold here too
                own.conf.set(key, value)
    parts = -(-stored_bytes(spark, paths) // PARTITION_BYTES)
    own.conf.set("spark.sql.shuffle.partitions", str(max(parts, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    for key, most in TASK_BYTES.items():
        if _bytes(spark.conf.get(key)) > most:
            own.conf.set(key, f"{most}b")
    return own
