"""Files that appear whole and once: what several writers, or several tries of one, agree on.

Of writers that create the same path one succeeds. The content is written beside it first, and
put in place by a step that fails where the path is there: a link on a local file
system, a rename elsewhere, which HDFS refuses for an existing target. A store whose rename
replaces the target gives no such promise and serves one writer only.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import unquote, urlparse

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    """The Hadoop file system of a path, and the path as its object."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _local(spark: SparkSession, path: str) -> str | None:
    system, hadoop = file_system(spark, path)
    whole = urlparse(system.makeQualified(hadoop).toString())
    return unquote(whole.path) if whole.scheme == "file" else None


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file with this content; false, and nothing changed, if it is there already."""
    local = _local(spark, path)
    # A leading dot hides it from readers of the folder until it is in place.
    folder, name = path.rsplit("/", 1)
    aside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    if local is not None:
        own = os.path.join(os.path.dirname(local), os.path.basename(aside))
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(own, "w", encoding="utf-8") as file:
            file.write(text)
            file.flush()
            os.fsync(file.fileno())
        try:
            os.link(own, local)
        except FileExistsError:
            return False
        finally:
            os.unlink(own)
        return True
    system, target = file_system(spark, path)
    source = spark._jvm.org.apache.hadoop.fs.Path(aside)
    stream = system.create(source, True)
    stream.write(text.encode("utf-8"))
    stream.close()
    if not system.exists(target) and system.rename(source, target):
        return True
    system.delete(source, False)
    return False


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    system, hadoop = file_system(spark, path)
    stream = system.open(hadoop)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted, but hidden ones; none if there is no such folder."""
    system, hadoop = file_system(spark, folder)
    if not system.exists(hadoop):
        return []
    return sorted(n for n in (s.getPath().getName() for s in system.listStatus(hadoop)) if not n.startswith("."))
