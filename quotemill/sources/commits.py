"""From one set of files of a stored table to the next, in one step.

New files are written aside, into a hidden folder of the table. Then one small file, ``_commit``, names what
moves in and which files go; it appears by a rename. Until then the old table is whole, from then on the
new one holds: files move in, old ones are deleted, notes are written, and ``_commit`` goes last. Each of
these can be repeated, so whoever comes next, reader or writer, first carries out a ``_commit`` that was cut
short. What Spark reads are plain Parquet files in partition folders; hidden folders it passes over.

Hidden notes beside the data: ``_schema`` (one schema for all partitions), ``_table`` (layout, buckets, and the key and
order of a table that takes appended versions), ``_appended`` (these versions, a folder a batch), ``_spans``
(first and last time and rows of every symbol in every file).

A table has one writer at a time. The rename is one step on HDFS and on local disks.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

COMMIT, SCHEMA, TABLE, APPENDED, SPANS = "_commit", "_schema", "_table", "_appended", "_spans"


def hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def of_uri(spark: SparkSession, uri: str):
    """The path that Spark names by a URI, in ``_metadata.file_path`` and ``inputFiles``."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def read_note(spark: SparkSession, path: str) -> dict | None:
    fs, file = hadoop(spark, path)
    if not fs.exists(file):
        return None
    stream = fs.open(file)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def write_note(spark: SparkSession, path: str, value: dict) -> None:
    fs, file = hadoop(spark, path)
    stream = fs.create(file, True)
    try:
        stream.write(bytearray(json.dumps(value), "utf-8"))
    finally:
        stream.close()


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder that are not hidden; none if there is no folder."""
    fs, place = hadoop(spark, path)
    if not fs.exists(place):
        return []
    return [n for n in (f.getPath().getName() for f in fs.listStatus(place)) if not n.startswith(("_", "."))]


def live_files(spark: SparkSession, path: str) -> list[str]:
    """URIs of the data files of a folder."""
    if not names_in(spark, path):
        return []
    return list(spark.read.schema("_ int").option("recursiveFileLookup", "true").parquet(path).inputFiles())


def aside(path: str) -> str:
    """A fresh hidden folder of the table."""
    return f"{path}/_aside-{uuid.uuid4().hex}"


def commit(
    spark: SparkSession, path: str, moves: list[tuple[str, str]], gone: list[str], notes: dict[str, dict] | None = None,
    spent: tuple[str, ...] = (),
) -> None:
    """Switch the table. ``moves``: folders written aside and the folders below the table that take their files.
    ``gone``: URIs of files. ``notes``: name and content. ``spent``: folders below the table that are deleted at the end."""
    finish(spark, path)
    plan = {"moves": [list(m) for m in moves], "gone": gone, "notes": notes or {}, "spent": list(spent)}
    draft = f"{path}/{COMMIT}.{uuid.uuid4().hex}"
    write_note(spark, draft, plan)
    fs, place = hadoop(spark, draft)
    if not fs.rename(place, hadoop(spark, f"{path}/{COMMIT}")[1]):
        raise OSError(f"{path} has another writer")
    finish(spark, path)


def finish(spark: SparkSession, path: str) -> None:
    """Carry out a commit that was begun, if there is one."""
    plan = read_note(spark, f"{path}/{COMMIT}")
    if plan is None:
        return
    fs, table = hadoop(spark, path)
    for source, target in plan["moves"]:
        _move(spark, fs, hadoop(spark, source)[1], hadoop(spark, f"{path}/{target}" if target else path)[1])
    for uri in plan["gone"]:
        fs.delete(of_uri(spark, uri), False)
    for name, content in plan["notes"].items():
        write_note(spark, f"{path}/{name}", content)
    for folder in [source for source, _ in plan["moves"]] + [f"{path}/{name}" for name in plan["spent"]]:
        fs.delete(hadoop(spark, folder)[1], True)
    fs.delete(hadoop(spark, f"{path}/{COMMIT}")[1], False)


def _move(spark: SparkSession, fs, source, target) -> None:
    """Files of a folder into another; a folder that is not there yet moves as a whole."""
    if not fs.exists(source):
        return
    if not fs.exists(target):
        fs.mkdirs(target.getParent())
        if fs.rename(source, target):
            return
    for found in fs.listStatus(source):
        name = found.getPath().getName()
        if name.startswith(("_", ".")):
            continue
        place = spark._jvm.org.apache.hadoop.fs.Path(target, name)
        if found.isDirectory():
            _move(spark, fs, found.getPath(), place)
        else:
            fs.rename(found.getPath(), place)


def write_aside(df: DataFrame, path: str, partitions: tuple[str, ...] = ()) -> str:
    """The frame's rows in a hidden folder of the table, as they are to be stored."""
    folder = aside(path)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(folder)
    return folder
