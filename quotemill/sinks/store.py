"""Writing stored tables: series, single tables, write modes, keyed upsert, update log.

Series are partitioned by the year (and month) of each row. Rows are range-partitioned by
(partition, symbol, time) before the write: ranges are balanced by sampling, so that a
symbol or a year with most of the rows spreads over many tasks, and each file holds a
narrow run of symbols whose min/max statistics let a read of one symbol skip the rest.

A write reads and replaces only the files that hold a key of its batch; all others stay as they are. New
files are written aside and take effect in one step (``sources/commits.py``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from ..operators.columns import date_column, symbol_column, times_as_such
from ..operators.keyed import merge_by_key, merge_by_version, same_key, without_keys
from ..schemas import UPDATE_LOG, widest
from ..session import delete_path, scratch_path
from ..sources.commits import (
    APPENDED, SCHEMA, SPANS, TABLE, aside, commit, finish, live_files, names_in, of_uri, write_aside,
)
from ..sources.store import (
    BUCKET, SINGLE, appended_versions, read_or_empty, span_columns, stored_base, stored_layout, stored_schema, table_exists, table_note,
    table_path,
)

LAYOUTS = {"single": (SINGLE,), "year": ("year",), "month": ("year", "month"), "bucket": (BUCKET,)}
BUCKETS = 16  # of a new table in buckets, unless its first write says how many; a table keeps the number it was begun with
SMALL_BYTES = 64 << 20  # up to here a rewrite needs no sampling to spread its rows
SMALL_FILES = 8  # as many small files a partition may have before ``compact`` merges them

Combine = Callable[[DataFrame, DataFrame], DataFrame]


def with_partitions(
    df: DataFrame, layout: str, time: str = "", keys: Sequence[str] = (), buckets: int = BUCKETS
) -> DataFrame:
    """Year and month of each row, not of the first one; or the bucket its key hashes to."""
    if layout == "single":
        return df.withColumn(SINGLE, F.lit(0))
    if layout == "bucket":
        return df.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    parts = {"year": F.year(time), "month": F.month(time)}
    return df.withColumns({c: parts[c] for c in LAYOUTS[layout]})


def _spread(df: DataFrame, columns: Sequence[str], partitions: int | None) -> DataFrame:
    """Even ranges of the columns, sorted. Rows equal in all of them, such as copies of one
    row, still spread: the input partition they come from is the last range column."""
    sliced = df.withColumn("_slice", F.spark_partition_id())
    wanted = [*columns, "_slice"]
    ranged = sliced.repartitionByRange(partitions, *wanted) if partitions else sliced.repartitionByRange(*wanted)
    return ranged.drop("_slice").sortWithinPartitions(*columns)


def _check_layout(spark: SparkSession, root: str, table: str, layout: str) -> None:
    """A table keeps the layout it was begun with; files of two layouts cannot be read."""
    stored = stored_layout(spark, root, table)
    if stored is not None and stored != layout:
        raise ValueError(f"{table} is stored by {stored}, not by {layout}")


def _whole_schema(spark: SparkSession, path: str, new: StructType, found: bool) -> StructType:
    """The table's schema with the columns that are new, and those that come wider.

    Files written before are read with the wider type; a type that cannot hold the stored values is refused.
    """
    known = (stored_schema(spark, path) or stored_base(spark, path).schema) if found else StructType()
    fields = {f.name: f.dataType for f in known.fields}
    for field in new.fields:
        wide = widest(fields.setdefault(field.name, field.dataType), field.dataType)
        if wide is None:
            raise TypeError(f"{field.name} is stored as {fields[field.name].simpleString()}, not {field.dataType.simpleString()}")
        fields[field.name] = wide
    return StructType([StructField(name, kind, True) for name, kind in fields.items()])


def _typed(df: DataFrame, schema: StructType) -> DataFrame:
    """The frame's own columns, in the table's types."""
    wanted = {f.name: f.dataType for f in schema.fields}
    return df.select(*[
        F.col(f.name) if f.dataType == wanted[f.name] else F.col(f.name).cast(wanted[f.name]).alias(f.name)
        for f in df.schema.fields])


def _save(
    df: DataFrame, path: str, layout: str, schema: StructType, gone: Sequence[str] = (), time: str = "", symbol: str = "",
    note: dict | None = None, spent: tuple[str, ...] = (),
) -> None:
    """The frame's rows take the place of the files ``gone``, in one step; an empty frame replaces nothing but those."""
    spark = df.sparkSession
    folder = write_aside(_typed(df, schema), path, LAYOUTS[layout])
    moves = [(folder, "")]
    if layout in ("year", "month") and symbol and names_in(spark, folder):
        moves.append((_write_spans(spark, path, folder, layout, schema, time, symbol), f"{SPANS}/{uuid.uuid4().hex}"))
    known = {"layout": layout, **({"time": time, "symbol": symbol} if len(moves) > 1 else {})}
    notes = {SCHEMA: schema.jsonValue(), TABLE: {**table_note(spark, path), **known, **(note or {})}}
    commit(spark, path, moves, list(gone), notes, spent)


def _write_spans(spark: SparkSession, path: str, folder: str, layout: str, schema: StructType, time: str, symbol: str) -> str:
    """First and last time and number of rows of every symbol in every new file, from two of its columns."""
    keys, ends = span_columns(symbol, time, len(LAYOUTS[layout]) + 1)
    spans = spark.read.schema(schema).parquet(folder).groupBy(*keys).agg(*ends)
    out = aside(path)
    spans.coalesce(1).write.parquet(out)
    return out


def write_series(
    df: DataFrame,
    root: str,
    table: str,
    layout: str = "year",
    symbol: str = "symbol",
    time: str = "kline_time",
    mode: str = "overwrite",
    partitions: int | None = None,
) -> None:
    """Write bars; ``overwrite`` replaces the rows of each (year or month, symbol) the frame
    has and leaves the other symbols of those periods."""
    spark, path = df.sparkSession, table_path(root, table)
    df = times_as_such(df)
    _check_layout(spark, root, table, layout)
    found = table_exists(spark, root, table)
    if mode == "overwrite" and found:
        _exchange(df, root, table, layout, time, symbol)
        return
    _fold(spark, root, table)
    parted = with_partitions(df, layout, time)
    schema = _whole_schema(spark, path, parted.schema, found)
    _save(_spread(parted, [*LAYOUTS[layout], symbol, time], partitions), path, layout, schema, (), time, symbol)


def write_table(df: DataFrame, root: str, table: str, mode: str = "overwrite") -> None:
    """Write a single table. ``overwrite`` replaces it as a whole, columns and types included; an empty
    frame replaces nothing."""
    spark, path = df.sparkSession, table_path(root, table)
    _check_layout(spark, root, table, "single")
    parted = with_partitions(df, "single")
    found = table_exists(spark, root, table)
    if mode == "overwrite":
        if found and parted.isEmpty():
            return
        schema = _whole_schema(spark, path, parted.schema, False)
        _save(parted, path, "single", schema, live_files(spark, path), spent=_below(spark, path))
    else:
        _fold(spark, root, table)
        _save(parted, path, "single", _whole_schema(spark, path, parted.schema, found))


def _in_partitions(df: DataFrame, columns: Sequence[str], values: Sequence[tuple]) -> DataFrame:
    def one(value: tuple) -> Column:
        # Rows without a date are a partition as well.
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(columns, value)])

    return df.where(reduce(lambda a, b: a | b, map(one, values), F.lit(False)))


def _touched(df: DataFrame, columns: Sequence[str]) -> list[tuple]:
    """The partitions a frame has: one entry per year, month or bucket, however many rows."""
    return [tuple(r) for r in df.select(*columns).distinct().collect()]


def _where_found(base: DataFrame, batch: DataFrame, partitions: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The base's rows in the partitions of the batch, and of each column within the batch's least and greatest, so that
    statistics skip files and row groups. One aggregate over the batch: a row a partition."""
    ends = batch.groupBy(*partitions).agg(*[x for i, c in enumerate(columns) for x in (
        F.min(c).alias(f"_least{i}"), F.max(c).alias(f"_most{i}"), F.max(F.col(c).isNull()).alias(f"_null{i}"))]).collect()
    rows = _in_partitions(base, partitions, [tuple(r)[:len(partitions)] for r in ends])
    for i, c in enumerate(columns):
        kind = batch.schema[c].dataType
        least = [r[f"_least{i}"] for r in ends if r[f"_least{i}"] is not None]
        most = [r[f"_most{i}"] for r in ends if r[f"_most{i}"] is not None]
        test = F.col(c).between(F.lit(min(least)).cast(kind), F.lit(max(most)).cast(kind)) if least else F.lit(False)
        rows = rows.where(test | F.col(c).isNull() if any(r[f"_null{i}"] for r in ends) else test)
    return rows


def files_holding(base: DataFrame, batch: DataFrame, columns: Sequence[str]) -> list[str]:
    """URIs of the base's files that have a row equal to one of the batch in the columns (null equals null).

    Only these columns are read; the names of the files found come to the
    driver, which has listed them all to plan the scan.
    """
    found = base.select(*columns, F.col("_metadata.file_path").alias("_file")).alias("base")
    wanted = batch.select(*columns).distinct().alias("found")
    return [r[0] for r in found.join(wanted, same_key(columns, True), "left_semi").select("_file").distinct().collect()]


def _small(spark: SparkSession, uris: Sequence[str]) -> bool:
    """Whether these are a few files of few bytes."""
    if len(uris) > 256:
        return False
    places = [of_uri(spark, u) for u in uris]
    conf = spark._jsc.hadoopConfiguration()
    return sum(p.getFileSystem(conf).getFileStatus(p).getLen() for p in places) <= SMALL_BYTES


def _files(spark: SparkSession, path: str, uris: Sequence[str], schema: StructType) -> DataFrame:
    """The rows of some files of the table."""
    paths = [of_uri(spark, u).toString() for u in uris]
    return spark.read.schema(schema).option("basePath", path).parquet(*paths)


def _combine(
    df: DataFrame, root: str, table: str, layout: str, time: str, symbol: str, combine: Combine, touch: Sequence[str],
    copied: bool = False, keys: Sequence[str] = (), spent: tuple[str, ...] = (), buckets: int | None = None,
) -> None:
    """Rewrite the files that hold a row equal to one of ``df`` in the columns ``touch``, with ``combine(their rows, df)``.

    The batch is used several times, so it is computed once, into the shared folder, unless
    it is ``copied`` already. Read back it also has a known size, by which Catalyst decides
    whether its keys can be broadcast to the existing rows.
    """
    spark, path, columns = df.sparkSession, table_path(root, table), LAYOUTS[layout]
    _check_layout(spark, root, table, layout)
    if not spent:
        _fold(spark, root, table)
    buckets = table_note(spark, path).get("buckets", buckets or BUCKETS)
    parted = with_partitions(df, layout, time, keys, buckets)
    found = bool(names_in(spark, path))
    schema = _whole_schema(spark, path, parted.schema, found)
    for key in keys if layout == "bucket" and found else ():
        if schema[key].dataType != parted.schema[key].dataType or stored_base(spark, path).schema[key].dataType != schema[key].dataType:
            raise TypeError(f"{key} is stored as {stored_base(spark, path).schema[key].dataType.simpleString()}")  # another hash
    parted = _typed(parted, schema)
    copy = scratch_path(spark, "batch")
    try:
        if not copied:
            parted.write.parquet(copy)
            parted = spark.read.schema(parted.schema).parquet(copy)
        gone: list[str] = []
        if found:
            bounded = [c for c in touch if c not in columns]
            gone = files_holding(_where_found(stored_base(spark, path, schema), parted, columns, bounded), parted, touch)
        existing = _files(spark, path, gone, schema) if gone else spark.createDataFrame([], schema)
        merged = combine(existing, parted)
        sort = [*columns, *(keys if layout == "bucket" or not (symbol and time) else (symbol, time))]
        batch = list(parted.inputFiles())
        if batch and _small(spark, gone + batch):
            # Few enough bytes for a file a partition, without a sampling pass over both sides.
            merged = merged.repartition(*columns).sortWithinPartitions(*sort)
        elif layout != "single":
            merged = _spread(merged, sort, None)
        note = {"buckets": buckets} if layout == "bucket" else None
        _save(merged, path, layout, schema, gone, time, symbol, note, spent)
    finally:
        if not copied:
            delete_path(spark, copy)


def _exchange(
    df: DataFrame, root: str, table: str, layout: str, time: str, symbol: str, copied: bool = False
) -> None:
    """The batch takes the place of the stored rows of its (period, symbol) pairs."""
    pair = [*LAYOUTS[layout], symbol]

    def exchange(old: DataFrame, new: DataFrame) -> DataFrame:
        return without_keys(old, new.select(*pair).distinct(), pair).unionByName(new, allowMissingColumns=True)

    _combine(df, root, table, layout, time, symbol, exchange, pair, copied)


def upsert(
    df: DataFrame,
    root: str,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    layout: str = "single",
    time: str = "date",
    symbol: str = "symbol",
    newest_wins: bool = False,
    copied: bool = False,
    buckets: int | None = None,
) -> None:
    """Keyed write: the batch replaces existing rows of its keys, its last row per key wins.

    With ``newest_wins`` the row with the greater ``order`` stays, whichever side it is on.
    Only the files that hold a key of the batch are read as a whole and rewritten; a batch of new keys adds files.
    In a table partitioned by time the key has to hold the time column, so that a key cannot
    move to another partition. Layout ``bucket`` is for keys without a time: rows are partitioned by a hash of the key, always
    the same one, into as many ``buckets`` as the table's first write says (table bytes / 10 GB or so), so that few files are
    looked at.
    """
    _check_key(keys, layout, time)
    merge = merge_by_version if newest_wins else merge_by_key
    time, symbol = (c if c in df.columns else "" for c in (time, symbol))

    def combine(old: DataFrame, new: DataFrame) -> DataFrame:
        return merge(old, new, keys, order)

    _combine(df, root, table, layout, time, symbol, combine, keys, copied, keys, buckets=buckets)


def _check_key(keys: Sequence[str], layout: str, time: str) -> None:
    if layout in ("year", "month") and time not in keys:
        raise ValueError(f"the key of a table partitioned by {time} has to hold {time}")


def append_versions(
    df: DataFrame, root: str, table: str, keys: Sequence[str], order: Sequence[str], name: str, layout: str = "single",
    time: str = "date", symbol: str = "symbol", buckets: int | None = None,
) -> None:
    """Add the batch's rows as versions of their keys: reads return the one with the greatest ``order``.

    Nothing stored is read or rewritten, so a batch costs its own bytes; ``compact`` folds versions in. A batch of
    the same ``name`` takes the place of the one before, so that one that is run again has no second effect.
    """
    spark, path = df.sparkSession, table_path(root, table)
    _check_key(keys, layout, time)
    _check_layout(spark, root, table, layout)
    note = table_note(spark, path)
    wanted = {"layout": layout, "keys": list(keys), "order": list(order), "time": time, "symbol": symbol, "buckets": note.get("buckets", buckets or BUCKETS)}
    if "keys" in note and appended_versions(spark, path) and (note["keys"], note["order"]) != (wanted["keys"], wanted["order"]):
        raise ValueError(f"{table} has versions by {note['keys']} and {note['order']}")
    parted = with_partitions(times_as_such(df), layout, time, keys, wanted["buckets"])
    schema = _whole_schema(spark, path, parted.schema, stored_schema(spark, path) is not None or bool(names_in(spark, path)))
    folder = write_aside(_typed(parted, schema), path)
    if not names_in(spark, folder):
        delete_path(spark, folder)
        return
    gone = live_files(spark, f"{path}/{APPENDED}/{name}")
    commit(spark, path, [(folder, f"{APPENDED}/{name}")], gone, {SCHEMA: schema.jsonValue(), TABLE: {**note, **wanted}})


def _below(spark: SparkSession, path: str) -> tuple[str, ...]:
    return tuple(v.removeprefix(f"{path}/") for v in appended_versions(spark, path))


def _fold(spark: SparkSession, root: str, table: str) -> None:
    """Writes other than of versions find none of them left."""
    if appended_versions(spark, table_path(root, table)):
        compact(spark, root, table)


def compact(spark: SparkSession, root: str, table: str) -> None:
    """Fold appended versions into the files of their keys, or merge the small files of partitions that have many."""
    path = table_path(root, table)
    finish(spark, path)
    versions = appended_versions(spark, path)
    note = table_note(spark, path)
    if versions:
        schema = stored_schema(spark, path)
        rows = spark.read.schema(schema).parquet(*versions).drop(*LAYOUTS[note["layout"]])
        keys, order = note["keys"], note["order"]
        time, symbol = (c if c in rows.columns else "" for c in (note["time"], note["symbol"]))
        _combine(
            rows, root, table, note["layout"], time, symbol, lambda old, new: merge_by_version(old, new, keys, order), keys,
            keys=keys, spent=_below(spark, path))
    else:
        _merge_small(spark, root, table)


def _merge_small(spark: SparkSession, root: str, table: str) -> None:
    path, layout = table_path(root, table), stored_layout(spark, root, table)
    if layout is None:
        return
    columns = LAYOUTS[layout]
    base = stored_base(spark, path)
    small = base.select(*columns, F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_size").alias("_size")).where(
        F.col("_size") < SMALL_BYTES // 2).distinct()
    many = small.groupBy(*columns).agg(F.collect_list("_file").alias("_files")).where(F.size("_files") > SMALL_FILES)
    gone = [f for r in many.select("_files").collect() for f in r[0]]  # names of files, as the scan's plan has them
    if not gone:
        return
    schema = stored_schema(spark, path) or base.schema
    rows = _files(spark, path, gone, schema)
    time, symbol = date_column(rows) or "", symbol_column(rows) or ""
    dated = layout in ("year", "month")
    sort = [*columns, *([symbol, time] if dated and symbol else [])]
    merged = _spread(rows, sort, None) if layout != "single" else rows.coalesce(max(1, len(gone) // SMALL_FILES))
    _save(merged, path, layout, schema, gone, time, symbol if dated else "")


def write(
    df: DataFrame,
    root: str,
    table: str,
    if_exists: str = "append",
    keys: Sequence[str] | None = None,
    order: Sequence[str] = (),
    layout: str = "single",
    copied: bool = False,
) -> None:
    """Append, replace or fail.

    In a partitioned table ``replace`` and ``fail`` look at (period, symbol): replace
    exchanges the rows of those pairs and leaves the other symbols of the year. Append with
    keys is an upsert. A table without a date column is written without partitions.
    """
    spark = df.sparkSession
    time = date_column(df)
    if layout == "bucket" and not (if_exists == "append" and keys):
        raise ValueError("a table in buckets of a key takes keyed appends only")
    layout = layout if time or layout == "bucket" else "single"
    dated, columns = layout in ("year", "month"), LAYOUTS[layout]
    df = times_as_such(df) if dated else df
    symbol = symbol_column(df)
    if if_exists == "append" and keys:
        if not order:
            raise ValueError("a keyed append needs the order in which later rows win")
        upsert(df, root, table, keys, order, layout, time or "", symbol or keys[0], copied=copied)
    elif if_exists == "append":
        if dated:
            write_series(df, root, table, layout, symbol, time, "append")
        else:
            write_table(df, root, table, "append")
    elif if_exists == "replace":
        if dated:
            _exchange(df, root, table, layout, time, symbol, copied)
        else:
            write_table(df, root, table, "overwrite")
    elif if_exists == "fail":
        if dated:
            pair = [*columns, symbol]
            parted = with_partitions(df, layout, time)
            existing = read_or_empty(spark, table_path(root, table), parted.schema)
            existing = _in_partitions(existing, columns, _touched(parted, columns))
            taken = existing.select(*pair).distinct().alias("base").join(
                parted.select(*pair).distinct().alias("found"), same_key(pair, True), "left_semi")
            if not taken.isEmpty():
                raise FileExistsError(f"{table} already has some of these symbols and years")
            write_series(df, root, table, layout, symbol, time, "append")
        else:
            if table_exists(spark, root, table):
                raise FileExistsError(f"{table} already exists")
            write_table(df, root, table, "append")
    else:
        raise ValueError("if_exists is append, replace or fail")


def write_to_targets(
    df: DataFrame, targets: Sequence[dict], rows: int | None = None, copied: bool = False
) -> int:
    """The same frame to several targets, computed once: through a written copy in the
    shared folder, which outlives a lost executor as a cache does not. ``copied`` says the
    frame is one already. Returns rows written, summed over targets."""
    spark = df.sparkSession
    copy = None
    try:
        if len(targets) > 1 and not copied:
            copy = scratch_path(spark, "targets")
            df.write.parquet(copy)
            df, copied = spark.read.schema(df.schema).parquet(copy), True
        for target in targets:
            options = {k: v for k, v in target.items() if k in ("if_exists", "keys", "order", "layout")}
            write(df, target["root"], target["table"], copied=copied, **options)
        written = df.count() if rows is None else rows
    finally:
        if copy:
            delete_path(spark, copy)
    return written * len(targets)


def log_rows(
    df: DataFrame,
    table: str,
    run_type: str,
    source: str,
    run_time: str,
    status: str = "ok",
    data_date: str | None = None,
    by_symbol: bool = True,
    error: str | None = None,
) -> DataFrame:
    """Log records of one write: rows per symbol, or of the whole batch. ``run_time`` is
    ``YYYY-MM-DD HH:MM:SS``; the data date is the run date unless given."""
    symbol = symbol_column(df) if by_symbol else None
    rows = F.count(F.lit(1)).alias("rows_count")
    counted = df.groupBy(F.col(symbol).cast("string").alias("symbol")).agg(rows) if symbol else df.agg(rows)
    fixed = {
        "table_name": table, "run_type": run_type, "run_date": run_time[:10],
        "data_date": data_date or run_time[:10], "source": source, "status": status,
        "error_msg": error, "start_time": run_time,
    }
    known = set(counted.columns)
    return counted.select(*[
        (F.col(f.name) if f.name in known else F.lit(fixed.get(f.name))).cast(f.dataType).alias(f.name)
        for f in UPDATE_LOG.fields
    ])


def log_update(df: DataFrame, root: str, table: str, run_type: str, source: str, run_time: str, **kw) -> None:
    """Append the log records of a write."""
    records = log_rows(df, table, run_type, source, run_time, **kw)
    write_table(records, root, "update_log", "append")


def read_log(spark: SparkSession, root: str) -> DataFrame:
    return read_or_empty(spark, table_path(root, "update_log"), UPDATE_LOG)


def json_records(df: DataFrame) -> DataFrame:
    """Each row as one JSON object with ISO dates; null fields are kept."""
    options = {
        "ignoreNullFields": "false", "dateFormat": "yyyy-MM-dd",
        "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss",
    }
    return df.select(F.to_json(F.struct(*[F.col(c) for c in df.columns]), options).alias("record"))


def write_json(df: DataFrame, path: str) -> None:
    json_records(df).withColumnRenamed("record", "value").write.mode("overwrite").text(path)

