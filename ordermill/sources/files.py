"""File listing and moving through the session's Hadoop file systems, so any shared storage works."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """File names in a folder, hidden ones left out; empty when the folder is missing."""
    if not path_exists(spark, folder):
        return []
    found = _file_system(spark, folder).listStatus(_path(spark, folder))
    names = [status.getPath().getName() for status in found]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def delete_folder(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = _file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that appears complete or not at all; fails when it exists.

    Needs storage that renames in one step and refuses to replace a file, as HDFS and local disks do; object
    stores without that need a committer of their own.
    """
    fs, target = _file_system(spark, path), _path(spark, path)
    hidden = _path(spark, f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    hidden, target = fs.makeQualified(hidden), fs.makeQualified(target)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    rename = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark._sc._gateway.new_array(rename, 0)
    try:
        context.rename(hidden, target, options)
    except Py4JJavaError as error:
        fs.delete(hidden, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            raise FileExistsError(path) from error
        raise


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file, replacing an older one."""
    fs, target = _file_system(spark, path), _path(spark, path)
    stream = fs.create(target, True)
    stream.write(bytearray(text, "utf-8"))
    stream.close()


def only_match(spark: SparkSession, pattern: str) -> str:
    """The one file or folder that fits a pattern; the pattern itself when there is none."""
    found = _file_system(spark, pattern).globStatus(_path(spark, pattern)) or []
    names = sorted(status.getPath().toString() for status in found)
    if len(names) > 1:
        raise ValueError(f"{pattern} matches {len(names)} files: {', '.join(names)}")
    return names[0] if names else pattern


def move_single_part(spark: SparkSession, folder: str, target: str) -> None:
    """Give the only part file of a written folder the name `target`, replacing an older file."""
    fs = _file_system(spark, folder)
    parts = fs.globStatus(_path(spark, f"{folder}/part-*"))
    if len(parts) != 1:
        raise ValueError(f"{folder} holds {len(parts)} part files, expected 1")
    destination = _path(spark, target)
    if fs.exists(destination):
        fs.delete(destination, False)
    if not fs.rename(parts[0].getPath(), destination):
        raise OSError(f"could not move {parts[0].getPath()} to {target}")
    fs.delete(_path(spark, folder), True)


def file_inventory(spark: SparkSession, pattern: str) -> DataFrame:
    """Name and size of the files matching `pattern`. Contents are not read."""
    files = spark.read.format("binaryFile").load(pattern)
    return files.selectExpr("element_at(split(path, '/'), -1) AS file_name", "length AS bytes")
