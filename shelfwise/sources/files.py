"""Names, existence and atomic creation of files in any store that Spark can reach."""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    fs, at = _at(spark, path)
    return sorted(f.getPath().getName() for f in fs.listStatus(at)) if fs.exists(at) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.exists(at)


def make_folder(spark: SparkSession, path: str) -> bool:
    fs, at = _at(spark, path)
    return fs.mkdirs(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _at(spark, path)
    fs.delete(at, True)


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _at(spark, path)
    stream = fs.open(at)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file whose content is ``text`` unless there is one; of several that try, one alone gets ``True``.

    A reader never sees it half written in a store whose creation is exclusive and visible at close; on a local disk
    a finished file is linked to the name, which fails if the name is taken.
    """
    fs, at = _at(spark, path)
    fs.mkdirs(at.getParent())
    uri = urlparse(at.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toString())
    if uri.scheme == "file":
        return link_once(unquote(uri.path), text.encode())
    try:
        stream = fs.create(at, False)
    except Exception as e:  # py4j hands every Java exception on as one kind
        if "FileAlreadyExists" in str(e) or fs.exists(at):
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def link_once(path: str, content: bytes) -> bool:
    """The same on a local disk."""
    folder, name = os.path.split(path)
    draft = os.path.join(folder, f".{name}.{os.getpid()}.{os.urandom(8).hex()}")
    with open(draft, "wb") as f:
        f.write(content)
    try:
        os.link(draft, path)
    except FileExistsError:
        return False
    finally:
        os.unlink(draft)
    return True
