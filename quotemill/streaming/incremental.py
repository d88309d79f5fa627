"""Incremental load of a landing folder as a stream of micro-batches into a keyed table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.columns import normalize_names
from ..operators.validate import Spec, clean, with_order
from ..sinks.store import append_versions, compact
from ..sources.store import appended_versions, table_path


def upsert_stream(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    root: str,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    layout: str = "single",
    time: str = "date",
    validate: Spec | None = None,
    prepare: Callable[[DataFrame], DataFrame] = normalize_names,
    files_per_batch: int = 1000,
    format: str = "parquet",
    compact_after: int | None = 16,
    buckets: int | None = None,
) -> StreamingQuery:
    """Take in the files that have arrived since the last run, then stop.

    Every batch is normalised, validated and appended as versions of its keys, so that it writes its own bytes and
    reads nothing that is stored; readers get the row with the greatest ``order``. A batch that is run again
    after a failure takes its own place, and an old file that arrives late changes nothing: the effect of each row is
    once. When ``compact_after`` batches have gathered they are folded into the files that hold their keys (None:
    only ``sinks.store.compact`` does so). Nothing is windowed, hence no watermark and no state.
    """
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]
    path = table_path(root, table)
    files = (
        spark.readStream.format(format).schema(schema)
        .option("maxFilesPerTrigger", files_per_batch).load(landing)
    )

    def take_in(batch: DataFrame, number: int) -> None:
        rows = prepare(batch)
        if validate is not None:
            rows = clean(rows, with_order(validate, order))
        append_versions(rows, root, table, keys, order, f"{source}-{number:012d}", layout, time, buckets=buckets)
        if compact_after is not None and len(appended_versions(spark, path)) >= compact_after:
            compact(spark, root, table)

    return (
        files.writeStream.foreachBatch(take_in)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
