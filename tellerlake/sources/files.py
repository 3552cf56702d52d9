"""Delivered files: CSV by position, Parquet by name, with casts that never lose a value silently."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from tellerlake.functions.dates import from_epoch_micros
from tellerlake.functions.text import null_tokens_to_null
from tellerlake.operators.joins import written
from tellerlake.schemas import is_required
from tellerlake.sources.quoted import escaped, read_quoted

# Columns bind by position, the header line is skipped, short rows are padded
# with NULL, surplus fields are ignored, and "" inside quotes is a quote. A line
# break inside quotes belongs to the field.
CSV_OPTIONS = {
    "header": "true",
    "enforceSchema": "true",
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "multiLine": "true",
}


def csv_options(header: bool = True, multi_line: bool = True) -> dict[str, str]:
    """``multi_line=False`` spares a look at the quotes; give it only for sources
    known to have no line breaks inside fields, as it would cut such records in two."""
    return {**CSV_OPTIONS, "header": str(header).lower(), "multiLine": str(multi_line).lower()}


def text_schema(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


def csv_text(
    spark: SparkSession, paths: str | list[str], schema: StructType, header: bool = True, multi_line: bool = True
) -> DataFrame:
    """All fields as text, NULL tokens resolved. Large files are split over tasks either way."""
    options = csv_options(header, multi_line)
    if multi_line:
        return resolve_nulls(read_quoted(spark, paths, text_schema(schema), options, header))
    return resolve_nulls(spark.read.schema(text_schema(schema)).options(**options).csv(paths))


def resolve_nulls(df: DataFrame) -> DataFrame:
    return df.select(*[null_tokens_to_null(F.col(c)).alias(c) for c in df.columns])


def strict_cast(column: Column, name: str, target: DataType) -> Column:
    """Cast, or fail the job naming the column and value. Done in the same pass as the
    load, so nothing is scanned twice and a failed load commits nothing."""
    failed = F.raise_error(
        F.concat(F.lit(f"cannot load {name} as {target.simpleString()}: "), column.cast("string"))
    )
    return F.coalesce(column.try_cast(target), F.when(column.isNotNull(), failed).cast(target))


def required(column: Column, name: str) -> Column:
    """The column, or fail the job on a NULL, in the same pass as the load."""
    return F.coalesce(column, F.raise_error(F.lit(f"cannot load a row without {name}")))


def loaded(column: Column, field: StructField, cast: bool = True) -> Column:
    """One column of a delivery, cast and checked as its declaration says."""
    if cast:
        column = strict_cast(column, field.name, field.dataType)
    return (required(column, field.name) if is_required(field) else column).alias(field.name)


def typed(text: DataFrame, schema: StructType) -> DataFrame:
    return text.select(*[loaded(F.col(f.name), f, not isinstance(f.dataType, StringType)) for f in schema.fields])


def read_csv(
    spark: SparkSession, paths: str | list[str], schema: StructType, header: bool = True, multi_line: bool = True
) -> DataFrame:
    return typed(csv_text(spark, paths, schema, header, multi_line), schema)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Pick columns by name and cast them; integers bound for a timestamp are epoch
    microseconds, a column the data lacks is NULL, and an error if rows must have it."""
    present = {f.name.lower(): f for f in df.schema.fields}

    def pick(field: StructField) -> Column:
        found = present.get(field.name.lower())
        if found is None:
            if is_required(field):
                raise ValueError(f"the delivery has no column {field.name}: {df.columns}")
            return F.lit(None).cast(field.dataType).alias(field.name)
        column = F.col(f"`{found.name}`")
        if found.dataType == field.dataType:
            return loaded(column, field, cast=False)
        if isinstance(field.dataType, TimestampNTZType) and isinstance(found.dataType, (LongType, IntegerType)):
            return loaded(from_epoch_micros(column), field, cast=False)
        if isinstance(field.dataType, TimestampNTZType) and isinstance(found.dataType, TimestampType):
            return loaded(column.cast(field.dataType), field, cast=False)
        return loaded(column, field)

    return df.select(*[pick(f) for f in schema.fields])


def read_parquet(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else paths
    return conform(spark.read.parquet(*paths), schema)


def with_load_audit(df: DataFrame, load_id: int, loaded_at: datetime) -> DataFrame:
    """Stamp one load; a delivery without a creation time gets the load time."""
    stamp = F.lit(loaded_at).cast("timestamp_ntz")
    if "created_timestamp" not in df.columns and "transaction_id" not in df.columns:
        df = df.withColumn("created_timestamp", stamp)
    return df.withColumns({"_loaded_at": stamp, "_load_id": F.lit(load_id)})


def list_files(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """One row per file below the folder, whatever its name, without reading any content."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob is not None:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(folder).select("path", "length", "modificationTime")


def unloaded_files(files: DataFrame, load_log: DataFrame) -> DataFrame:
    """Files whose path no earlier load has recorded."""
    return files.join(load_log.select("path"), "path", "left_anti")


def new_files(spark: SparkSession, folder: str, load_log: DataFrame, per_block: int) -> Iterator[list[str]]:
    """Names of the files below the folder that the log lacks, some ``per_block`` at a time.

    The folder is listed and the names are compared; no content is opened. Spark's
    reader takes names from the driver, so only a block of them is there at a time.
    """
    fresh = written(unloaded_files(list_files(spark, folder), load_log).select("path"), "new-files")
    blocks = -(-fresh.count() // per_block)
    for block in range(blocks):
        yield [row.path for row in fresh.where(F.pmod(F.xxhash64("path"), F.lit(blocks)) == block).collect()]


def read_new_csv(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    load_log: DataFrame,
    multi_line: bool = True,
    per_block: int = 10_000,
) -> tuple[DataFrame, DataFrame]:
    """The rows of files not loaded yet, and the log entries to append once they are written.

    Loaded files are left out by name, before anything is read: however long the
    history, a load opens the new delivery only.
    """
    blocks = list(new_files(spark, folder, load_log, per_block))
    reads = [read_csv(spark, [escaped(p) for p in paths], schema, multi_line=multi_line) for paths in blocks if paths]
    empty = spark.createDataFrame([], schema)
    entries = [spark.createDataFrame([(p,) for p in paths], "path string") for paths in blocks if paths]
    no_entries = spark.createDataFrame([], "path string")
    return reduce(DataFrame.union, reads) if reads else empty, reduce(DataFrame.union, entries) if entries else no_entries
