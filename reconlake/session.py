"""Session helpers shared by all operators."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cores: int | str = "*", partitions: int = 8, app: str = "reconlake") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of the input folder."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoint(): the one the cluster names in spark.checkpoint.dir.

    Where the setting is absent, a private local folder is made if driver and executors share one machine, as in tests;
    on a cluster that is an error, as executors could not read each other's files.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        if not named and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="reconlake-checkpoint-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Materialise df in the shared checkpoint folder and cut its lineage; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers that do not share the driver's path."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    sc = spark.sparkContext
    on_path = root in map(os.path.abspath, filter(None, os.environ.get("PYTHONPATH", "").split(os.pathsep)))
    if getattr(sc, "_reconlake_shipped", False) or on_path and sc.master.startswith("local"):
        return
    import zipfile

    target = os.path.join(tempfile.mkdtemp(prefix="reconlake-ship-"), "reconlake.zip")
    with zipfile.ZipFile(target, "w") as z:
        base = os.path.join(root, "reconlake")
        for folder, _, files in os.walk(base):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    sc._reconlake_shipped = True


def joined(left: DataFrame, right: DataFrame, on: Column | str | list[str], how: str = "inner") -> DataFrame:
    """left.join(right, on, how) that is never broadcast, for sides that both grow with the input.

    The planner compares its broadcast threshold with compressed shuffle bytes; strings and arrays below it can be many times
    that once the driver has built them.
    """
    return left.join(right.hint("merge"), on, how)


def bounded(df: DataFrame, most: int) -> DataFrame:
    """Broadcast hint if df really has at most `most` rows, counted; otherwise the join stays a shuffle join."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df
