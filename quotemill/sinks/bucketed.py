"""Tables in Spark's own buckets, for keyed work without a shuffle.

Rows are written once in buckets of a key, (symbol, date) by default, so that a symbol with a third of all rows
spreads over all buckets. Joins and windows on the key then read bucket by bucket: a comparison of sources, keeping the
last row of a key or an anti-join against a batch in the same buckets need no Exchange.

A write makes a new folder and switches one small note to it, then deletes the folder before. The catalog
of the session knows a table only while it lives; ``read_bucketed`` names the folder to it again.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..session import delete_path
from ..sources.commits import hadoop, read_note, write_note
from ..sources.store import table_path

NOTE = "_bucketed"
KEYS = ("symbol", "date")


def write_bucketed(
    df: DataFrame, root: str, table: str, keys: Sequence[str] = KEYS, buckets: int = 64, sort: Sequence[str] | None = None,
) -> None:
    """Replace the table by the frame's rows, one sorted file a bucket. ``buckets`` is table bytes / 256 MB or so; tables
    that are to meet without a shuffle need the same keys and number."""
    spark, path = df.sparkSession, table_path(root, table)
    before = read_note(spark, f"{path}/{NOTE}")
    note = {
        "folder": f"data-{uuid.uuid4().hex}", "keys": list(keys), "sort": list(sort or keys), "buckets": buckets,
        "schema": df.schema.jsonValue()}
    name = _name(note)
    (
        df.repartition(buckets, *keys).write.format("parquet").option("compression", "zstd")
        .option("path", f"{path}/{note['folder']}").bucketBy(buckets, *keys).sortBy(*note["sort"]).saveAsTable(name))
    # the note takes the place of the one before by a rename, so that there is always a whole one
    draft = f"{path}/{NOTE}.{uuid.uuid4().hex}"
    write_note(spark, draft, note)
    fs, place = hadoop(spark, draft)
    target = hadoop(spark, f"{path}/{NOTE}")[1]
    options = spark._jvm.org.apache.hadoop.fs.Options
    renames = spark._sc._gateway.new_array(getattr(options, "Rename"), 1)
    renames[0] = getattr(options, "Rename").OVERWRITE
    spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
        fs.makeQualified(place), fs.makeQualified(target), renames)
    if before:
        spark.sql(f"DROP TABLE IF EXISTS {_name(before)}")
        delete_path(spark, f"{path}/{before['folder']}")


def _name(note: dict) -> str:
    return "bucketed_" + note["folder"].removeprefix("data-")


def read_bucketed(spark: SparkSession, root: str, table: str) -> DataFrame:
    path = table_path(root, table)
    note = read_note(spark, f"{path}/{NOTE}")
    if note is None:
        raise FileNotFoundError(f"{table} is not stored in buckets")
    name = _name(note)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(note["schema"]).fields)

        def listed(names: list[str]) -> str:
            return ", ".join(f"`{n}`" for n in names)

        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({listed(note['keys'])}) SORTED BY ({listed(note['sort'])}) "
            f"INTO {note['buckets']} BUCKETS LOCATION '{path}/{note['folder']}'")
    return spark.table(name)
