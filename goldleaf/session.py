"""Session defaults, and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"

#: Keyed state of streams on disk, backed up beside their checkpoint.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    # Megabytes of empty log per partition otherwise.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

_local_dirs: dict[str, str] = {}
_made: list[str] = []


def build(app: str = "goldleaf", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        # A model call costs money: a second copy of a slow task would pay it twice.
        "spark.speculation": "false",
        # A repeated key in a model's answer: the last one counts.
        "spark.sql.variant.allowDuplicateKeys": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings that hold inside the block only; a stream started there keeps them."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only a local master, where all tasks share the machine, gets one of its own.
    """
    named = spark.conf.get(CHECKPOINT_KEY, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors share")
    return _local_dirs.setdefault(
        context.applicationId, tempfile.mkdtemp(prefix="goldleaf-")
    )


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Scratch tables made inside the block are deleted when it ends.

    Frames that read them have to be used before. Several threads of a session share one list.
    """
    start = len(_made)
    try:
        yield
    finally:
        hadoop = spark._jvm.org.apache.hadoop.fs
        for path in _made[start:]:
            place = hadoop.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
        del _made[start:]


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table: later reads cannot evaluate it a second time."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def local_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A few rows of bookkeeping as a one-partition frame, without a job to distribute them."""
    return spark.sql(
        f"SELECT inline(from_json(:rows, 'array<struct<{schema}>>'))", args={"rows": json.dumps(rows)}
    )
