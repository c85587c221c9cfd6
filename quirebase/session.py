"""Session settings and table access shared by every query."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_given: list[str] = []  # scratch folders not released yet


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "quirebase", **conf: str) -> SparkSession:
    """A session with the settings that results depend on (UTC) and AQE on."""
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the project's tables by name."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    The cluster names a shared folder there. A local temporary folder is used
    only where the setting is missing and the master is local, as in tests.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.environ.get("QUIREBASE_SCRATCH") or tempfile.mkdtemp(prefix="spark-quirebase-")
    folder = f"{base.rstrip('/')}/quirebase-{uuid.uuid4().hex}"
    _given.append(folder)
    return folder


def release(spark: SparkSession) -> int:
    """Delete the scratch folders given out so far; their number.

    Results that weren't read or written elsewhere yet are lost with them, so
    it is the caller who knows when.
    """
    done = len(_given)
    while _given:
        remove(spark, _given.pop())
    return done


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a path in whatever file system it names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens where there is none."""
    fs, where = hadoop_path(spark, path)
    fs.delete(where, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file at once: it is there whole or not at all."""
    fs, where = hadoop_path(spark, path)
    _, part = hadoop_path(spark, f"{path}.part-{uuid.uuid4().hex}")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, where):
        raise OSError(f"{path} can't be written")


def get_text(spark: SparkSession, path: str) -> str:
    """What a small file holds."""
    fs, where = hadoop_path(spark, path)
    source = fs.open(where)
    try:
        return bytes(source.readAllBytes()).decode()
    finally:
        source.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, in order; none where there is no such folder."""
    fs, where = hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def materialise(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as a table in the scratch folder and read it back.

    Cuts the lineage, and what was written survives the loss of any executor.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
