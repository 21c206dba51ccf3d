"""File-system checks through Hadoop's FileSystem (any scheme: file, hdfs, s3a, ...)."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def children(spark: SparkSession, path: str, prefix: str) -> int:
    """How many entries of a folder start with `prefix` (0 for a missing folder)."""
    fs, p = _fs_path(spark, path)
    return sum(s.getPath().getName().startswith(prefix) for s in fs.listStatus(p)) if fs.exists(p) else 0


def status(spark: SparkSession, path: str) -> tuple[int, int]:
    """(length, modification time) of a file or folder."""
    fs, p = _fs_path(spark, path)
    st = fs.getFileStatus(p)
    return int(fs.getContentSummary(p).getLength()), int(st.getModificationTime())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of a folder's entries (none for a missing folder)."""
    fs, p = _fs_path(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def create(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new file; False, and nothing done, if there is one of that name. On an object store this needs conditional creates."""
    fs, p = _fs_path(spark, path)
    local = fs.getScheme() == "file"  # whose create() only looks first
    try:
        if local:
            fs.mkdirs(p.getParent())
            if not spark.sparkContext._jvm.java.io.File(p.toUri().getPath()).createNewFile():
                return False
        stream = fs.create(p, local)
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception) or fs.exists(p):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def replace(spark: SparkSession, path: str, text: str) -> None:
    """Write a file, over the one of that name."""
    fs, p = _fs_path(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Remove a file or a folder with all it holds."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)
