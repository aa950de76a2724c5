"""A log of numbered entries that several writers may extend at once.

Entry n is a file of its own, made only if it is absent, whole from the first moment: its content is written aside and then
given its name in one step that fails if the name is taken. Who fails reads the log again and decides anew, so
every decision is taken on all entries before its own, and numbers have no gaps.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _name(number: int) -> str:
    return f"{number:012d}.json"


def _local(folder: str) -> str | None:
    """The path of a folder on a mounted file system."""
    if folder.startswith("file:"):
        return "/" + folder[5:].lstrip("/")
    return folder if "://" not in folder else None


def create_if_absent(spark: SparkSession, folder: str, name: str, content: str) -> bool:
    """Make a file whole or not at all; False if there is one. Mounted folders use a hard link, others Hadoop's
    rename without overwriting, which is atomic on HDFS."""
    aside = f".{uuid.uuid4().hex}.tmp"
    if (root := _local(folder)) is not None:
        os.makedirs(root, exist_ok=True)
        under = os.path.join(root, aside)
        with open(under, "x", encoding="utf-8") as out:
            out.write(content)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(under, os.path.join(root, name))
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(under)
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(path)
    under, target = hadoop.Path(path, aside), hadoop.Path(path, name)
    out = store.create(under, False)
    out.write(content.encode())
    out.close()
    if store.exists(target) or not store.rename(under, target):
        store.delete(under, False)
        return False
    return True


def entries(spark: SparkSession, folder: str, schema: str) -> DataFrame | None:
    """All entries as a table, or None before the first one."""
    try:
        return spark.read.schema(schema).option("pathGlobFilter", "[0-9]*.json").json(folder)
    except Exception as e:  # the folder does not exist before the first entry
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def append(
    spark: SparkSession, folder: str, schema: str, decide: Callable[[list[dict], int], dict], number: str = "sequence"
) -> dict:
    """Add the entry that ``decide`` makes of the entries before it and its number; decided anew if another came first."""
    while True:
        table = entries(spark, folder, schema)
        known = sorted((r.asDict() for r in table.collect()), key=lambda r: r[number]) if table is not None else []
        entry = decide(known, len(known) + 1)
        content = json.dumps(entry, default=str)
        if create_if_absent(spark, folder, _name(len(known) + 1), content + "\n"):
            return entry
