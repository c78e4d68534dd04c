"""Small wrappers over the Hadoop file system, so paths work on local disk, HDFS and object stores alike.

Only names, lengths and renames pass through the driver, never table data.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    name: str
    is_dir: bool
    length: int


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def entries(spark: SparkSession, path: str) -> list[Entry]:
    """Children of a directory, ordered by name; empty when it does not exist."""
    if not exists(spark, path):
        return []
    found = [
        Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen())
        for s in _fs(spark, path).listStatus(_path(spark, path))
    ]
    return sorted(found, key=lambda e: e.name)


def walk(spark: SparkSession, path: str) -> list[Entry]:
    """All files below a directory, at any depth."""
    found = []
    for entry in entries(spark, path):
        found += walk(spark, entry.path) if entry.is_dir else [entry]
    return found


def glob(spark: SparkSession, pattern: str) -> list[Entry]:
    found = _fs(spark, pattern).globStatus(_path(spark, pattern)) or []
    return sorted(
        (Entry(s.getPath().toString(), s.getPath().getName(), s.isDirectory(), s.getLen()) for s in found),
        key=lambda e: e.path,
    )


def total_bytes(spark: SparkSession, path: str) -> int:
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def rename(spark: SparkSession, source: str, target: str) -> None:
    parent = _path(spark, target).getParent()
    _fs(spark, target).mkdirs(parent)
    if not _fs(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"could not rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)


def make_transient(spark: SparkSession, path: str) -> None:
    """Create a folder that the file system removes when the application ends."""
    _fs(spark, path).mkdirs(_path(spark, path))
    _fs(spark, path).deleteOnExit(_path(spark, path))


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    stream = _fs(spark, path).create(_path(spark, path), True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def create_whole(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file appear with its whole text under a name that nothing has yet; False when something has it.

    The text is written under a name of its own and takes its place by a rename that does not replace. On file systems
    without such a rename the file is created there without replacing.
    """
    draft = f"{path}.{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    jvm = spark._jvm
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration())
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        context.rename(_path(spark, draft), _path(spark, path), options)
        return True
    except Py4JJavaError as error:
        name = error.java_exception.getClass().getSimpleName()
        if name == "FileAlreadyExistsException":
            remove(spark, draft)
            return False
        if name != "UnsupportedFileSystemException":
            raise
    remove(spark, draft)
    try:
        stream = _fs(spark, path).create(_path(spark, path), False)
    except Py4JJavaError:
        if not exists(spark, path):
            raise
        return False
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    return True
