"""Small files and folders on any storage that Hadoop's file system API reaches: local disks, HDFS, object stores. Paths without
a scheme follow the session's default file system. Metadata only; tables go through Spark's readers and writers."""

from __future__ import annotations

from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import SparkSession


def _at(path: str | Path):
    """(file system, its path object)."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(str(path))
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(path: str | Path) -> bool:
    fs, p = _at(path)
    return fs.exists(p)


def is_folder(path: str | Path) -> bool:
    fs, p = _at(path)
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def is_file(path: str | Path) -> bool:
    fs, p = _at(path)
    return fs.exists(p) and fs.getFileStatus(p).isFile()


def folders(path: str | Path) -> list[str]:
    """The names of the folders in a folder, in order."""
    fs, p = _at(path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []


def files(pattern: str | Path) -> list[str]:
    """The files that a path or pattern names, and those in the folders that it names, in order; hidden ones are left out."""
    fs, p = _at(pattern)
    out = []
    for s in fs.globStatus(p) or ():
        inside = [s] if s.isFile() else fs.listStatus(s.getPath())
        out += [x.getPath().toString() for x in inside if x.isFile() and x.getPath().getName()[0] not in "._"]
    return sorted(out)


def make_folder(path: str | Path) -> None:
    fs, p = _at(path)
    fs.mkdirs(p)


def remove(path: str | Path) -> None:
    """The file or folder, if it is there."""
    fs, p = _at(path)
    fs.delete(p, True)


def read_text(path: str | Path) -> str:
    fs, p = _at(path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_text(path: str | Path, parts: Iterable[str], batch: int = 1 << 20) -> None:
    """Writes the parts one after another, so that the whole is never in memory; replaces what is there."""
    fs, p = _at(path)
    stream = fs.create(p, True)
    try:
        held: list[str] = []
        size = 0
        for part in parts:
            held.append(part)
            size += len(part)
            if size >= batch:
                stream.write("".join(held).encode("utf-8"))
                held, size = [], 0
        stream.write("".join(held).encode("utf-8"))
    finally:
        stream.close()
