"""Files wherever Spark reads them: local disk, HDFS, object stores.

Paths mean what they mean to ``spark.read``; the session's file systems answer.
Without a session (a helper called alone) the local disk does.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

Location = str | Path


def location(path: Location) -> Location:
    """A URI stays a text (``Path`` would lose a slash), anything else is a Path."""
    return path if isinstance(path, str) and ":/" in path else Path(path)


def join(folder: Location, name: str) -> Location:
    return f"{folder.rstrip('/')}/{name}" if isinstance(folder, str) else folder / name


def _system(path: Location):
    spark = SparkSession.getActiveSession()
    if spark is None:
        return None, None
    at = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(path: Location) -> bool:
    system, at = _system(path)
    return Path(path).exists() if system is None else bool(system.exists(at))


def read_text(path: Location) -> str:
    """The text of a small file; OSError if there is none."""
    if not exists(path):
        raise FileNotFoundError(str(path))
    system, at = _system(path)
    if system is None:
        return Path(path).read_text()
    stream = system.open(at)
    try:
        return SparkSession.getActiveSession()._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(path: Location, text: str) -> None:
    system, at = _system(path)
    if system is None:
        Path(path).write_text(text)
        return
    stream = system.create(at, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def remove(path: Location) -> None:
    system, at = _system(path)
    if system is None:
        Path(path).unlink(missing_ok=True)
    else:
        system.delete(at, True)


def upload(local: Path, path: Location) -> None:
    """Moves a file of the driver's disk to where executors can read it."""
    system, at = _system(path)
    system.copyFromLocalFile(True, True, SparkSession.getActiveSession()._jvm.org.apache.hadoop.fs.Path(f"file://{local}"), at)
