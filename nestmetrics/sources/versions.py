"""Versioned folders: a group of tables is replaced as a whole or not at all.

A load writes its tables below a folder of its own. Publishing it adds one small record, numbered one above the
last, by a rename of a finished file, so readers see either the version before or the new one. A load that
fails publishes nothing. Readers resolve the newest record once and keep its folder, whatever is published
later. Two loads at a time get two numbers; the later one is what readers see.

::

    root/published/00000007     one line: the folder of the seventh version
    root/load-<unique>/...      the tables of one load

The rename must be atomic and must not replace a file, as on HDFS; on a plain local file system the second
condition holds up to a race of two publications.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

RECORDS = "published"
_ATTEMPTS = 20


@dataclass(frozen=True)
class Version:
    number: int
    folder: str


def _opened(spark: SparkSession, path: str):
    """The file system of a path, and the path in its terms."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _names(spark: SparkSession, folder: str) -> list[tuple[str, int]]:
    """Name and time of change in seconds of what lies in a folder; nothing if there is none."""
    fs, where = _opened(spark, folder)
    if not fs.exists(where):
        return []
    return [(s.getPath().getName(), s.getModificationTime() // 1000) for s in fs.listStatus(where)]


def _remove(spark: SparkSession, path: str) -> None:
    fs, where = _opened(spark, path)
    fs.delete(where, True)


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return sorted(int(name) for name, _ in _names(spark, f"{root}/{RECORDS}") if name.isdigit())


def _record(root: str, number: int) -> str:
    return f"{root}/{RECORDS}/{number:08d}"


def _read(spark: SparkSession, path: str) -> str:
    fs, where = _opened(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def begin(root: str) -> str:
    """A fresh folder for the tables of one load."""
    return f"{root}/load-{uuid.uuid4().hex}"


def publish(spark: SparkSession, root: str, folder: str) -> Version:
    """Make a finished load the version that readers see."""
    name = folder.removeprefix(f"{root}/")
    draft = f"{root}/{RECORDS}/draft-{uuid.uuid4().hex}"
    fs, where = _opened(spark, draft)
    stream = fs.create(where, False)
    try:
        stream.write(bytearray(f"{name}\n".encode()))
    finally:
        stream.close()
    files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(spark._jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
    for attempt in range(_ATTEMPTS):
        number = max(_numbers(spark, root), default=0) + 1
        try:
            files.rename(where, spark._jvm.org.apache.hadoop.fs.Path(_record(root, number)), plain)
            return Version(number, f"{root}/{name}")
        except Py4JJavaError as error:
            # Another load has taken the number: go behind it.
            if "FileAlreadyExistsException" not in str(error.java_exception) or attempt == _ATTEMPTS - 1:
                _remove(spark, draft)
                raise
    raise AssertionError("unreachable")


def published(spark: SparkSession, root: str) -> list[Version]:
    """All versions that can still be read, oldest first."""
    return [Version(n, f"{root}/{_read(spark, _record(root, n))}") for n in _numbers(spark, root)]


def resolve(spark: SparkSession, root: str, number: int | None = None) -> Version:
    """The newest version, or one by its number."""
    numbers = _numbers(spark, root)
    if not numbers or (number is not None and number not in numbers):
        raise FileNotFoundError(f"no version{'' if number is None else f' {number}'} is published below {root}")
    chosen = numbers[-1] if number is None else number
    return Version(chosen, f"{root}/{_read(spark, _record(root, chosen))}")


def reclaim(spark: SparkSession, root: str, keep: int = 2, unfinished_hours: float = 24.0) -> list[str]:
    """Delete versions older than the last ``keep``, and loads of over so many hours ago that never published.

    Returns the folders deleted. Records go before their data, so no record names a folder that is gone. A
    reader still at work on a version that is deleted fails; keep as many as loads may happen while one reads.
    """
    if keep < 1:
        raise ValueError("the newest version stays")
    versions = published(spark, root)
    old, kept = versions[:-keep], {v.folder for v in versions[-keep:]}
    for version in old:
        _remove(spark, _record(root, version.number))
    gone = {v.folder for v in old} - kept
    known = kept | gone
    before = time.time() - unfinished_hours * 3600
    for name, changed in _names(spark, root):
        if name.startswith("load-") and f"{root}/{name}" not in known and changed < before:
            gone.add(f"{root}/{name}")
    for folder in gone:
        _remove(spark, folder)
    return sorted(gone)
