"""Small files put in place in one step, pointers to what is current, and files joined or removed.

These are calls of the file system that Spark itself uses, so they reach every path Spark does.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or a folder; nothing happens where there is none."""
    fs, place = _at(spark, path)
    fs.delete(place, True)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where there is no folder."""
    fs, place = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """A new file, whole or not at all; False if there is one already."""
    fs, place = _at(spark, path)
    _, waiting = _at(spark, f"{path}.{uuid.uuid4().hex}.waiting")
    out = fs.create(waiting)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    done = not fs.exists(place) and fs.rename(waiting, place)
    if not done:
        fs.delete(waiting, False)
    return done


def get_text(spark: SparkSession, path: str) -> str | None:
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def length(spark: SparkSession, path: str) -> int:
    fs, place = _at(spark, path)
    return fs.getFileStatus(place).getLen()


def replace(spark: SparkSession, path: str, target: str) -> None:
    """Moves a file to ``target``, in the place of what is there."""
    fs, place = _at(spark, path)
    _, to = _at(spark, target)
    fs.delete(to, True)
    if not fs.rename(place, to):
        raise OSError(f"{path} could not be moved to {target}")


def point(spark: SparkSession, folder: str, content: dict, kept: int = 2) -> list[dict]:
    """Makes ``content`` what ``pointed`` gives.  Pointers are numbered files, none is ever written over, so a reader finds
    the old one or the new one.  Returns the contents of those that fell out: all but the last ``kept``.
    """
    while True:
        there = [n for n in names(spark, folder) if n.isdigit()]
        number = int(there[-1]) + 1 if there else 1
        if put_text(spark, f"{folder}/{number:012d}", json.dumps(content)):
            break
    fallen = (there + [f"{number:012d}"])[:-kept]
    old = [json.loads(get_text(spark, f"{folder}/{n}") or "{}") for n in fallen]
    for n in fallen:
        delete(spark, f"{folder}/{n}")
    return old


def pointed(spark: SparkSession, folder: str, back: int = 0) -> dict | None:
    """The content put last, or as many times before as ``back`` says; None where there is none."""
    there = [n for n in names(spark, folder) if n.isdigit()]
    text = get_text(spark, f"{folder}/{there[-1 - back]}") if back < len(there) else None
    return json.loads(text) if text is not None else None


def join_files(spark: SparkSession, parts: list[str], path: str) -> None:
    """The bytes of ``parts``, one after the other, as one file; copied in small blocks."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, place = _at(spark, path)
    out = fs.create(place)
    try:
        for part in parts:
            source, where = _at(spark, part)
            stream = source.open(where)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
            finally:
                stream.close()
    finally:
        out.close()
