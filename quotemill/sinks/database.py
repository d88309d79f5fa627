"""Databases over JDBC: reading with pushdown, batch insert, table definition, merge."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..operators.columns import select_existing
from ..operators.keyed import keep_last

# Column type -> database type; text is sized by its longest value.
DATABASE_TYPES = {
    "bigint": "BIGINT", "int": "INT", "smallint": "SMALLINT", "tinyint": "SMALLINT",
    "double": "FLOAT", "float": "REAL", "boolean": "BIT", "timestamp": "DATETIME2",
    "timestamp_ntz": "DATETIME2", "date": "DATETIME2",
}
LONGEST_TEXT = 4000  # the longest sized text; longer values need the unbounded type
UNBOUNDED_TEXT = "NVARCHAR(MAX)"


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    columns: Sequence[str] | None = None,
    where: str | None = None,
    limit: int | None = None,
    split_by: tuple[str, int, int, int] | None = None,
    **options: str,
) -> DataFrame:
    """A database table; projection, predicate and limit run in the database.

    ``split_by`` = (column, low, high, parts) reads in parallel. Without it one task reads
    the whole table, so give it for anything large.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if split_by:
        column, low, high, parts = split_by
        reader = reader.options(
            partitionColumn=column, lowerBound=str(low), upperBound=str(high), numPartitions=str(parts)
        )
    df = reader.load()
    df = df.where(where) if where else df
    df = select_existing(df, columns)
    return df.limit(limit) if limit else df


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is no value in a database."""
    floats = [n for n, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def text_profile(df: DataFrame) -> DataFrame:
    """(column, max_length, values, dates) for every text column, in one aggregation.

    ``dates`` counts values that are eight digits, wherever they stand in the table.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, StringType)]
    if not texts:
        return df.sparkSession.createDataFrame(
            [], "column STRING, max_length INT, values BIGINT, dates BIGINT"
        )
    aggs: list[Column] = []
    for i, c in enumerate(texts):
        aggs += [
            F.max(F.length(c)).alias(f"len_{i}"), F.count(c).alias(f"n_{i}"),
            F.count_if(F.col(c).rlike("^[0-9]{8}$")).alias(f"d_{i}"),
        ]
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"len_{i}").alias("max_length"),
                 F.col(f"n_{i}").alias("values"), F.col(f"d_{i}").alias("dates"))
        for i, c in enumerate(texts)
    ]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def database_types(df: DataFrame) -> DataFrame:
    """(column, type) a table for this frame needs; text as wide as twice its longest value,
    ``YYYYMMDD`` text in a column named after a date as a date."""
    width = F.col("max_length") * 2
    limited = F.concat(F.lit("NVARCHAR("), F.least(width, F.lit(LONGEST_TEXT)).cast("string"), F.lit(")"))
    sized = F.when(F.col("max_length") > LONGEST_TEXT, F.lit(UNBOUNDED_TEXT)).when(F.col("max_length") > 0, limited)
    is_date = F.lower("column").contains("date") & (F.col("values") > 0) & (F.col("dates") == F.col("values"))
    texts = text_profile(df).select(
        "column", F.when(is_date, "DATETIME2").otherwise(F.coalesce(sized, F.lit("NVARCHAR(255)"))).alias("type")
    )
    plain = [(n, DATABASE_TYPES.get(t, UNBOUNDED_TEXT)) for n, t in df.dtypes if t != "string"]
    if not plain:
        return texts
    return texts.unionByName(df.sparkSession.createDataFrame(plain, "column STRING, type STRING"))


def create_statement(df: DataFrame, table: str, keys: Sequence[str] = ()) -> str:
    """CREATE TABLE for this frame: keys are not null and the primary key."""
    types = {r["column"]: r["type"] for r in database_types(df).collect()}  # one row a column
    lines = [f"{c} {types[c]} {'NOT NULL' if c in keys else 'NULL'}" for c in df.columns]
    if keys:
        lines.append(f"CONSTRAINT PK_{table} PRIMARY KEY ({', '.join(keys)})")
    return f"CREATE TABLE {table} (\n  " + ",\n  ".join(lines) + "\n)"


def write_database(
    df: DataFrame, url: str, table: str, mode: str = "append", batch: int = 5000, **options: str
) -> None:
    """Batch insert, one connection a partition."""
    text = {r["column"]: r["type"] for r in database_types(df).collect()} if mode == "overwrite" else {}
    named = ", ".join(f"{c} {t}" for c, t in text.items() if t.startswith("NVARCHAR"))
    if named:
        options["createTableColumnTypes"] = named.replace("NVARCHAR", "VARCHAR")
    writer = nan_to_null(df).write.format("jdbc").mode(mode)
    writer.options(url=url, dbtable=table, batchsize=str(batch), **options).save()


def merge_into(df: DataFrame, table: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """MERGE into a catalog table whose format supports it; plain Parquet does not, for it
    use ``sinks.store.upsert``."""
    source = keep_last(df, keys, order)
    name = table.split(".")[-1]
    match = reduce(lambda a, b: a & b, [source[k] == F.expr(f"{name}.{k}") for k in keys])
    merge = source.mergeInto(table, match)
    merge.whenMatched().updateAll().whenNotMatched().insertAll().merge()
