"""Sketches of the partitions of a stored table, kept beside its data and renewed where files changed."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sketches import distinct_sketches, estimated_distinct
from ..session import delete_path
from ..sources.commits import finish, live_files, names_in, of_uri
from ..sources.store import stored_base, stored_layout, stored_schema, table_path
from .store import LAYOUTS

FOLDER = "_sketches"


def _partitions(spark: SparkSession, path: str, depth: int) -> dict[str, list[str]]:
    """Files by their partition folder below the table."""
    found: dict[str, list[str]] = {}
    for uri in live_files(spark, path):
        found.setdefault("/".join(uri.split("/")[-depth - 1:-1]), []).append(uri)
    return found


def _state(files: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(f.rsplit("/", 1)[1] for f in files)).encode()).hexdigest()


def refresh_sketches(spark: SparkSession, root: str, table: str, columns: Sequence[str]) -> int:
    """Renew the sketches of the columns; returns how many partitions had to be read. A partition with the same files as
    when it was last read is not read again."""
    path = table_path(root, table)
    finish(spark, path)
    what = ",".join(columns)
    known, old = {}, [f"{path}/{FOLDER}/{n}" for n in names_in(spark, f"{path}/{FOLDER}")]
    kept = None
    if old:
        kept = spark.read.parquet(*old)
        known = {(r["folder"], r["state"]) for r in kept.where(F.col("what") == what).select("folder", "state").collect()}
    depth = len(LAYOUTS[stored_layout(spark, root, table)])
    parts = {folder: (_state(files), files) for folder, files in _partitions(spark, path, depth).items()}
    new = {folder: files for folder, (state, files) in parts.items() if (folder, state) not in known}
    live = spark.createDataFrame([(f, s) for f, (s, _) in parts.items()], "folder string, state string")
    frames = []
    if known:
        frames.append(kept.where(F.col("what") == what).join(live, ["folder", "state"], "left_semi"))
    if new:
        schema = stored_schema(spark, path) or stored_base(spark, path).schema
        paths = [of_uri(spark, f).toString() for files in new.values() for f in files]
        rows = spark.read.schema(schema).option("basePath", path).parquet(*paths)
        folder = F.concat_ws("/", F.slice(F.split("_metadata.file_path", "/"), -depth - 1, depth)).alias("folder")
        made = distinct_sketches(rows.select(*columns, folder), {c: c for c in columns}, ["folder"])
        frames.append(made.join(live, "folder").withColumn("what", F.lit(what)))
    if not new and known:
        return 0
    if frames:
        whole = frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])
        whole.write.parquet(f"{path}/{FOLDER}/{uuid.uuid4().hex}")
        for folder in old:  # those of other columns are made anew when they are asked for
            delete_path(spark, folder)
    return len(new)


def stored_distinct(spark: SparkSession, root: str, table: str, columns: Sequence[str]) -> DataFrame:
    """rows, and the estimated distinct count of each column, of a stored table, as of now."""
    refresh_sketches(spark, root, table, columns)
    path = table_path(root, table)
    folders = [f"{path}/{FOLDER}/{n}" for n in names_in(spark, f"{path}/{FOLDER}")]
    return estimated_distinct(spark.read.parquet(*folders), list(columns))
