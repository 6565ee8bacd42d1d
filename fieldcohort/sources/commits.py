"""Small commit files in a shared folder, which say what belongs to a dataset.

A commit is a JSON file of a bounded size, written under another name and then
renamed, so readers see all of it or nothing. Data files count only if a commit
names them; what an attempt that failed has left is never read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _place(spark, path)
    return fs.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in one folder, without what lies below; none if it is missing."""
    fs, place = _place(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def files_below(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the data files of a folder that one attempt has written."""
    fs, place = _place(spark, folder)
    found, each = [], fs.listFiles(place, True)
    while each.hasNext():
        path = each.next().getPath()
        if not path.getName().startswith(("_", ".")):
            found.append(path.toString())
    return sorted(found)


def read(spark: SparkSession, path: str):
    """The content of a commit; None if there is none."""
    fs, place = _place(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write(spark: SparkSession, path: str, content, replace: bool = True) -> bool:
    """Commit ``content``; without ``replace`` the first one stays, and the result says whether it was this."""
    fs, place = _place(spark, path)
    if not replace and fs.exists(place):
        return False
    fs.mkdirs(place.getParent())
    draft = spark._jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}-{uuid.uuid4().hex[:8]}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(content).encode()))
    finally:
        stream.close()
    if replace and fs.exists(place):
        fs.delete(place, False)
    done = (replace or not fs.exists(place)) and fs.rename(draft, place)
    if not done:
        fs.delete(draft, False)
    return done
