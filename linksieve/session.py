"""Session defaults and lineage cuts."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(app: str = "linksieve", cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # beyond this size the JIT compiler skips a method, and whole-stage code is slower than none
        "spark.sql.codegen.hugeMethodLimit": "8000",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point the context at the shared folder the session names.

    A local session without one gets a scratch folder. A cluster without one is
    an error: a folder on one machine does not survive that machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get(CHECKPOINT_CONF, None)
    if configured is None:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="linksieve-checkpoint-")
    context.setCheckpointDir(configured)


def checkpointed(df: DataFrame) -> DataFrame:
    """Write ``df`` to the checkpoint folder once and continue from the files."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the checkpoint folder, for tables that stages hand over."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
