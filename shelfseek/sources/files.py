"""Product files: gzipped JSON arrays and gzipped JSON lines, one JSON object text per row.

A bad file or line does not end the read: it becomes a row with a ``reject_reason``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfseek.functions.records import parse_object

BAD_FILE = "not_a_json_array"
BAD_LINE = "not_json"
NOT_OBJECT = "not_an_object"


def read_json_array(
    spark: SparkSession, path: str, failfast: bool = False, partitions: int | None = None
) -> DataFrame:
    """(value, source_file, reject_reason) for each element of the arrays in ``path``.

    A gzip file is read by one task, so many moderate files spread the work; ``partitions`` spreads
    the rows after the read.
    """
    files = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("value").alias("_text"),
        F.from_json("value", "array<variant>").alias("_elements"),
    )
    element = F.col("_element")
    rows = files.select(
        "source_file",
        F.when(F.col("_elements").isNull(), F.col("_text")).alias("_text"),
        F.explode_outer("_elements").alias("_element"),
    ).filter(element.isNotNull() | F.col("_text").isNotNull())
    is_object = element.try_cast("map<string,variant>").isNotNull()
    reason = F.when(element.isNull(), BAD_FILE).when(~is_object, NOT_OBJECT)
    value = F.coalesce(F.to_json(element), F.col("_text"))
    return _finished(rows.select(value.alias("value"), "source_file", reason.alias("reject_reason")), failfast, partitions)


def read_ndjson(
    spark: SparkSession, path: str, failfast: bool = False, partitions: int | None = None
) -> DataFrame:
    """(value, source_file, reject_reason) for each line that is not blank of the files in ``path``."""
    return _finished(_checked_lines(spark.read.text(path)), failfast, partitions)


def stream_ndjson(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The same as a stream: files that come to ``path`` are read once each."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _checked_lines(reader.text(path))


def _checked_lines(lines: DataFrame) -> DataFrame:
    text = F.col("value")
    reason = F.when(F.try_parse_json(text).isNull(), BAD_LINE).when(parse_object(text).isNull(), NOT_OBJECT)
    return lines.filter(F.trim(text) != "").select(
        text, F.col("_metadata.file_path").alias("source_file"), reason.alias("reject_reason")
    )


def _finished(rows: DataFrame, failfast: bool, partitions: int | None) -> DataFrame:
    if failfast:
        rows = rows.withColumn("reject_reason", _raise(F.col("reject_reason"), F.col("source_file")))
    return rows.repartition(partitions) if partitions else rows


def _raise(reason: Column, source: Column) -> Column:
    message = F.concat(reason, F.lit(" in "), source)
    return F.when(reason.isNotNull(), F.raise_error(message).cast("string"))


def good(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNull()).drop("reject_reason")


def bad(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("reject_reason").isNotNull())
