"""Small files and listings through Hadoop's file systems: commits, manifests, summaries."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Listed:
    path: str
    bytes: int
    modified: int


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names in a folder; none where it is not there."""
    fs, where = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def data_files(spark: SparkSession, folder: str) -> list[Listed]:
    """Parquet files below a folder; names that start with _ or . are none."""
    fs, where = _at(spark, folder)
    found: list[Listed] = []
    if not fs.exists(where):
        return found
    walk = fs.listFiles(where, True)
    while walk.hasNext():
        s = walk.next()
        path = s.getPath()
        if path.getName().endswith(".parquet") and path.getName()[0] not in "_.":
            found.append(Listed(path.toString(), s.getLen(), s.getModificationTime()))
    return sorted(found, key=lambda f: f.path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, fresh: bool = False) -> None:
    """A small file, whole or not at all: written aside, then renamed.  `fresh`: an error if it is there already."""
    fs, where = _at(spark, path)
    if fresh and fs.exists(where):
        raise FileExistsError(path)
    aside = where.suffix(".tmp")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(where):
        fs.delete(where, False)
    if not fs.rename(aside, where):
        raise OSError(f"could not write {path}")


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)
