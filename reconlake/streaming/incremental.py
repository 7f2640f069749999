"""Resumable work over a landing folder with Structured Streaming.

Each run processes what has arrived since the last one and ends (availableNow); progress is kept in the checkpoint
folder, so a run that is cut off goes on where it stopped. Upserts keep the latest delivery of each key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from reconlake.operators.overrides import latest


PARTS = 64  # parts of the state by hash of the key; a run rewrites only those its keys fall in


def run_available(spark: SparkSession, landing: str, schema: StructType, state: str, checkpoint: str, key: str, order: str, parts: int = PARTS) -> int:
    """Fold new files into the state table: one row a key, the latest by order. Number of rows of the state afterwards.

    A run writes the parts of the state that its keys touch as a new version beside the old ones, so a reader or a retry
    never sees half of it; what a version before the last one replaced is removed. `parts` stays the same for a state.
    """
    part = F.pmod(F.xxhash64(key), F.lit(parts)).cast("int").alias("_part")

    def merge(batch: DataFrame, batch_id: int) -> None:
        touched = [r[0] for r in batch.select(part).distinct().collect()]  # at most `parts` numbers
        old = current_state(spark, state, batch_id, touched)
        rows = batch if old is None else old.unionByName(batch, allowMissingColumns=True)
        kept = latest(rows, [key], [F.desc(order)]).withColumn("_part", part)
        kept.repartition("_part").write.mode("overwrite").partitionBy("_part").parquet(f"{state}/v={batch_id}")
        _remove_replaced(spark, state, batch_id)

    stream = spark.readStream.schema(schema).parquet(landing)
    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    now = current_state(spark, state)
    return 0 if now is None else now.count()


def _versions(spark: SparkSession, state: str) -> dict[int, list[int]]:
    """By part, the complete versions that hold it, in order."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(state)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out: dict[int, list[int]] = {}
    if not fs.exists(path):
        return out
    for s in fs.listStatus(path):
        name = s.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            for t in fs.listStatus(s.getPath()):
                if t.getPath().getName().startswith("_part="):
                    out.setdefault(int(t.getPath().getName()[6:]), []).append(int(name[2:]))
    return {p: sorted(v) for p, v in out.items()}


def _remove_replaced(spark: SparkSession, state: str, now: int) -> None:
    """Remove the parts that a version before `now` replaced; those that `now` replaces stay for readers and retries."""
    jvm = spark.sparkContext._jvm
    for part, versions in _versions(spark, state).items():
        older = [v for v in versions if v < now]
        for v in older[:-1]:
            path = jvm.org.apache.hadoop.fs.Path(f"{state}/v={v}/_part={part}")
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def current_state(spark: SparkSession, state: str, before: int | None = None, parts: list[int] | None = None) -> DataFrame | None:
    """The state after the last complete version, or the last before a batch, of all or some parts; None if there is none."""
    paths = []
    for part, versions in sorted(_versions(spark, state).items()):
        versions = [v for v in versions if before is None or v < before]
        if versions and (parts is None or part in parts):
            paths.append(f"{state}/v={versions[-1]}/_part={part}")
    return spark.read.option("mergeSchema", True).parquet(*paths) if paths else None


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by event time window and kind; events later than `late` are dropped by the watermark of a stream."""
    return events.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n"))


def first_deliveries(stream: DataFrame, key: str, time: str, late: str = "2 hours") -> DataFrame:
    """Each key once within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
