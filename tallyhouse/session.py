"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


MIB = 1 << 20


def sizing(input_bytes: int, cores: int) -> dict[str, str]:
    """Scan and shuffle settings for a run over `input_bytes` of raw data on `cores`.

    Adaptive execution merges small shuffle partitions but does not split large ones, so the number
    it starts from has to fit the data. Beyond some 50,000 partitions and 200,000 scan tasks the
    shuffle's block count grows faster than smaller tasks help; sorts in larger tasks spill.
    """
    scan = min(1024 * MIB, max(128 * MIB, input_bytes // 200_000))
    partitions = min(50_000, max(cores, -(-input_bytes // (256 * MIB))))
    return {
        "spark.sql.files.maxPartitionBytes": str(scan),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * MIB if input_bytes > 1 << 40 else 64 * MIB),
    }


def build_session(app: str = "tallyhouse", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution and skew handling on; `settings` go on top.

    Pass `**sizing(...)` for runs over large tables.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in {**defaults, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder for intermediate tables and checkpoints.

    It lies in the shared folder named by `spark.checkpoint.dir`. A session without that setting
    gets a temporary folder of its own if it runs in one process; a cluster has to name a folder, as each
    executor would write to a disk of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir has to name a shared folder on {master or 'a cluster'}")
        shared = tempfile.mkdtemp(prefix="tallyhouse-")
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def forget_shuffles(batch: DataFrame) -> None:
    """Delete the shuffle files behind a batch of a stream that is written; Spark would keep them until the batch has ended.

    Were they needed once more, Spark would make them again.
    """
    cleaner = batch.sparkSession.sparkContext._jsc.sc().cleaner()
    plan = batch._jdf.logicalPlan()
    todo = [plan.rdd()] if plan.nodeName() == "LogicalRDD" and cleaner.isDefined() else []
    while todo:
        found = todo.pop().dependencies()
        for dependency in (found.apply(k) for k in range(found.length())):
            if dependency.getClass().getSimpleName() == "ShuffleDependency":
                cleaner.get().doCleanupShuffle(dependency.shuffleId(), True)
            todo.append(dependency.rdd())


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists on whatever file system the path names."""
    file_system, target = _file_system(spark, path)
    return file_system.exists(target)


def child_names(spark: SparkSession, path: str, pattern: str) -> list[str]:
    """Names right below a folder that match a glob, without listing what they hold."""
    file_system, _ = _file_system(spark, path)
    found = file_system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}"))
    return sorted(status.getPath().getName() for status in found or [])


def delete_matching(spark: SparkSession, path: str, pattern: str) -> None:
    """Delete what a glob below a folder of this package finds."""
    file_system, _ = _file_system(spark, path)
    for status in file_system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{pattern}")) or []:
        file_system.delete(status.getPath(), True)


def move_path(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file to another name on the same file system; False if that did not work."""
    file_system, old = _file_system(spark, source)
    new = spark._jvm.org.apache.hadoop.fs.Path(target)
    file_system.mkdirs(new.getParent())
    return file_system.rename(old, new)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder and those above it."""
    file_system, target = _file_system(spark, path)
    file_system.mkdirs(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of a table this package wrote."""
    file_system, target = _file_system(spark, path)
    file_system.delete(target, True)
