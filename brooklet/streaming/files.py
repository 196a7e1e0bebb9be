"""Small files beside the data: listing, reading, and creating one that must not be there yet.

Spark's API has none of these, so this module, and no other, asks Hadoop's file systems through the
session's JVM. It holds no rows of data: only names and commit texts of a few kilobytes pass here.
"""

from __future__ import annotations

import os
import uuid
from urllib.parse import urlparse

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def children(spark: SparkSession, path: str) -> list[str] | None:
    """Names in a folder of any file system that Spark can write to; None if it is not there."""
    system, place = _place(spark, path)
    if not system.exists(place):
        return None
    return [entry.getPath().getName() for entry in system.listStatus(place)]


def read_text(spark: SparkSession, path: str) -> str:
    system, place = _place(spark, path)
    stream = system.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def claim(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with this text; False if the file is there already. Nobody sees half of it.

    The text goes to a file of its own, which then gets the wanted name: by a hard link on the local
    file system, elsewhere by a rename that does not replace, which HDFS does in one step. A store
    without such a step needs a single writer.
    """
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        folder, draft, path = (urlparse(p).path for p in (folder, draft, path))
        os.makedirs(folder, exist_ok=True)
        with open(draft, "w", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(draft, path)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    jvm = spark._jvm
    system, place = _place(spark, draft)
    system.mkdirs(place.getParent())
    stream = system.create(place, False)
    stream.write(bytearray(text, "utf-8"))
    stream.close()
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    never_replace = spark.sparkContext._gateway.new_array(kind, 1)
    never_replace[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    target = jvm.org.apache.hadoop.fs.Path(path)
    try:
        context.rename(place, target, never_replace)
        return True
    except Exception:
        system.delete(place, False)
        if system.exists(target):
            return False
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder with all that is in it; nothing if it is not there."""
    system, place = _place(spark, path)
    system.delete(place, True)
