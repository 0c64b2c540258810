"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# What the plans rely on. Every one is a runtime SQL setting, so `tune` also works on a session
# that a cluster has already started.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot stations: split their shuffle partitions, even if that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # The projections of 20 to 35 columns would become methods too long for the JIT compiler (8000
    # bytes), which then stay interpreted; shorter generated methods run several times faster.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Readings are zone-less wall-clock times; the session zone must not move them.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a running session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


@contextlib.contextmanager
def tuned_for(spark: SparkSession) -> Iterator[SparkSession]:
    """The runtime settings for a while; afterwards the session has its own again.

    Time zone and ANSI mode are taken into a plan when it is built, so a DataFrame that is built inside keeps them.
    """
    before = {key: spark.conf.get(key, None) for key in RUNTIME_SETTINGS}
    try:
        yield tune(spark)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def local_session(cores: int | str = "*", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the bench; on a cluster use its own session and `tune` it."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("atmolake")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        # Without it every Column call looks up its call site, which more than doubles the time to build wide plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


@functools.cache
def _local_base() -> str:
    """A folder of this process, gone when it ends."""
    folder = tempfile.mkdtemp(prefix="atmolake-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under `spark.checkpoint.dir`, the folder all executors share.

    Only a local session may fall back to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _local_base()
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
