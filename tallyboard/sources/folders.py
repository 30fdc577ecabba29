"""Small files and folders in whatever store a path names, from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _handle(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _handle(spark, path)
    return fs.exists(p)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder, in order; none where there is no folder."""
    fs, p = _handle(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _handle(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def claim(spark: SparkSession, path: str) -> None:
    """Create an empty file that must not exist yet; of two that try, one fails."""
    fs, p = _handle(spark, path)
    fs.create(p, False).close()


def mark(spark: SparkSession, path: str) -> None:
    """Create an empty file, or leave one that is there as empty."""
    fs, p = _handle(spark, path)
    fs.create(p, True).close()


def publish(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it is there whole or not at all."""
    fs, p = _handle(spark, path)
    _, part = _handle(spark, f"{path}.part")
    stream = fs.create(part, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if not fs.rename(part, p):
        raise OSError(f"cannot publish {path}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _handle(spark, path)
    fs.delete(p, True)
