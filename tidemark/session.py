"""Session factory and the two settings every plan here relies on."""

from __future__ import annotations

import os
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession


def local_session(name: str = "tidemark", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session as tests and the bench use it; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def make_importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, whatever folder they start in.
    Where executors don't see that place, ship the package with ``--py-files``."""
    root = str(Path(__file__).resolve().parents[1])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder that checkpoint() writes to.

    A cluster names a shared one in ``spark.checkpoint.dir``. Where that is unset, a local master
    gets a temporary folder; any other master is refused, as its executors could not read one.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    return str(context.getCheckpointDir())
