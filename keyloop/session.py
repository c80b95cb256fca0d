"""Session helpers: a tuned local session for tests/bench and the shared scratch folder.

On a cluster the session is built by the caller; nothing here overrides settings that are
already present. The scratch folder always comes from ``spark.checkpoint.dir`` so that
checkpoints, state directories and streaming checkpoints live on shared storage.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on.  AQE re-plans joins from runtime sizes, coalesces small
# shuffle partitions and splits skewed ones; the session time zone is pinned so that
# timestamp arithmetic is reproducible.
TUNED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "keyloop", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the benchmark (``local[N]``)."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (SparkSession.builder
               .master(master or f"local[{cpus}]")
               .appName(app_name)
               .config("spark.driver.memory", os.environ.get("KEYLOOP_DRIVER_MEM", "16g"))
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus)))
    for k, v in {**TUNED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_root(spark)
    return spark


_LOCAL_SCRATCH: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written state.

    Read from the session's ``spark.checkpoint.dir``.  Only when it is unset and the master
    is local (tests, the local benchmark) a fresh temp folder is created and registered as
    the context's checkpoint dir.  On a cluster an unset value is an error: a machine-local
    folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not d:
        key = sc.applicationId
        if key not in _LOCAL_SCRATCH:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder "
                                   "(checkpoints and keyed state are written there)")
            _LOCAL_SCRATCH[key] = tempfile.mkdtemp(prefix="keyloop-")
        d = _LOCAL_SCRATCH[key]
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A path below the shared scratch folder; ``unique`` appends a fresh id."""
    base = "/".join([scratch_root(spark), *parts])
    return f"{base}-{uuid.uuid4().hex[:12]}" if unique else base
