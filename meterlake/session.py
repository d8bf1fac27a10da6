"""Spark session defaults and the shared scratch folder."""
from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # wall-clock readings are timestamp_ntz; pin the zone for anything zoned (streaming watermarks)
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "meterlake",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint directory; a local temporary one only when none is configured on a
    local master (tests). Executors of a cluster do not share such a folder: there it is an error."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir()
    if not base:
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            if not (sc.master == "local" or sc.master.startswith("local[")):
                raise RuntimeError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
            conf_dir = tempfile.mkdtemp(prefix="meterlake-ckpt-")
        sc.setCheckpointDir(conf_dir)
        base = sc.getCheckpointDir()
    return base


def observed_rows(seen: Observation, df: DataFrame) -> int:
    """``rows`` of an observation of ``df``. Spark reports nothing where it found at run time that no row passes the shuffle
    above; the rows are counted then."""
    try:
        return int(seen.get["rows"])
    except Py4JJavaError:
        return df.count()


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder by Hadoop's file systems, wherever ``path`` lies."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def path_exists(spark: SparkSession, pattern: str) -> bool:
    """Whether a path, or any that matches a pattern, exists (asked of Hadoop's file systems, no failing read)."""
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


@contextmanager
def session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the queries inside; what it was before afterwards."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The directory comes from the session (``spark.checkpoint.dir`` or
    ``SparkContext.setCheckpointDir``); see ``ensure_checkpoint_dir`` for when
    neither is set.
    """
    base = ensure_checkpoint_dir(spark)
    name = "-".join(parts) if parts else "scratch"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["DEFAULT_CONF", "get_session", "delete_path", "ensure_checkpoint_dir", "observed_rows", "path_exists", "session_conf", "shared_dir"]
