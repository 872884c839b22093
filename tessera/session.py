"""Session helpers: a local session for tests and the reliable checkpoint
folder used to cut lineage in iterative jobs.

On a cluster the checkpoint folder comes from ``spark.checkpoint.dir`` (a
shared file system). Only when the session has none (local tests) do we make
one, and only for a local master.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(cpus: int | str = "*", app: str = "tessera") -> SparkSession:
    """Local session used by tests and the bench (never on a cluster);
    shuffle partitions follow the core count."""
    cores = int(cpus) if str(cpus).isdigit() else (os.cpu_count() or 8)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's reliable checkpoint folder, set from
    ``spark.checkpoint.dir`` when present; a fresh temp folder only for a
    local master that has none."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not conf:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir must name a shared folder on a cluster"
            )
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
    sc.setCheckpointDir(conf)
    return sc._jsc.sc().getCheckpointDir().get()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the checkpoint folder for written tables."""
    base = checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable, eager checkpoint: survives executor loss and keeps plans of
    iterative jobs from growing."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
