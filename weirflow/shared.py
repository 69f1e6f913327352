"""The shared working folder, and small file operations in it.

Everything that must outlive an executor is written below ``spark.checkpoint.dir``, which the cluster
names; a folder of our own is made only in local mode, as in tests, where neither the session nor the context has one.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_scratch: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; without one, an error on a cluster."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = known.get() if known.isDefined() else None
    if not folder:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="weirflow-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    p = hadoop.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it isn't there."""
    fs, p, _ = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p, _ = _fs(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file under its final name in one rename; False if the name is already taken."""
    fs, p, hadoop = _fs(spark, path)
    if fs.exists(p):
        return False
    temporary = hadoop.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(temporary, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    fs.mkdirs(p.getParent())
    if fs.rename(temporary, p):
        return True
    fs.delete(temporary, False)
    return False


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/weirflow/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: computed once, and safe against lost executors."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _clear() -> None:
    for spark, path in _scratch:
        try:
            remove(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            return
