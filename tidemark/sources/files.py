"""Scans of line files, and the numbers of their rows. CSV and JSON documents are in ``documents``."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import shared_dir
from tidemark.sources.documents import FILE, ROW_NUMBER, scan_csv, scan_json_array

__all__ = ["FILE", "ROW_NUMBER", "number_rows", "scan_csv", "scan_json_array", "scan_ndjson_lines"]


def number_rows(scan: DataFrame, first: int = 1) -> DataFrame:
    """Number the rows of each file in file order, however many splits Spark reads it in.

    Within one split, ``monotonically_increasing_id`` grows in reading order, so a row's place in its
    split is the distance to the split's first id. Adding the row counts of the file's earlier splits
    gives the place in the file.

    The files are read once. Rows with their file, split and id are written to shared storage, and both
    the offsets of the splits and the result are read from there: how Spark cuts files into splits depends
    on the cores it has at the time, so two scans of the files may differ. Only the per-split table is
    windowed, one small row per split; a row whose split has no offset is an error, not a row less.
    """
    located = scan.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias("_split"),
    ).withColumn("_id", F.monotonically_increasing_id())
    spark = scan.sparkSession
    folder = f"{shared_dir(spark)}/numbered/{uuid.uuid4().hex}"
    located.write.parquet(f"{folder}/rows")
    rows = spark.read.schema(located.schema).parquet(f"{folder}/rows")
    earlier = Window.partitionBy(FILE).orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    (
        rows.groupBy(FILE, "_split")
        .agg(F.min("_id").alias("_first_id"), F.count(F.lit(1)).alias("_rows"))
        .select(FILE, "_split", (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first_id")).alias("_offset"))
        .write.parquet(f"{folder}/splits")
    )
    splits = spark.read.schema(f"{FILE} string, _split bigint, _offset bigint").parquet(f"{folder}/splits")
    offset = F.coalesce(F.col("_offset"), F.raise_error(F.concat(F.lit("no offset for a split of "), FILE)).cast("bigint"))
    return (
        rows.join(splits, [FILE, "_split"], "left")
        .withColumn(ROW_NUMBER, F.col("_id") + offset + first)
        .drop("_id", "_offset", "_split")
    )


def scan_ndjson_lines(spark: SparkSession, path: str, numbered: bool = True) -> DataFrame:
    """(value, source_file, source_row_number) for every line of the files, blank ones included, since
    they count. Parsing is ``operators.intake.parse_json_lines``."""
    scan = spark.read.text(path)
    if not numbered:
        return scan.select("value", F.col("_metadata.file_path").alias(FILE))
    return number_rows(scan)
