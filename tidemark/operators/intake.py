"""Row-level steps between a source scan and the raw layer."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import distinct_keys
from tidemark.schemas import SourceSpec

# What a line is stripped of before it is parsed.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

MALFORMED = "malformed_json"
UNKNOWN_CUSTOMER = "invalid_fk_customer"

QUARANTINE_COLUMNS = ("source_file", "source_row_number", "reason", "error_detail", "raw_record")


def project_payload(df: DataFrame, spec: SourceSpec, extra: tuple[str, ...] = ()) -> DataFrame:
    """The declared payload as text: extra columns dropped, missing ones NULL."""
    present = set(df.columns)
    payload = [
        (F.col(c) if c in present else F.lit(None)).cast("string").alias(c) for c in spec.payload
    ]
    return df.select(*payload, *extra)


def stamp_metadata(
    df: DataFrame,
    spec: SourceSpec,
    batch_id: str | Column,
    ingested_at: str | datetime | Column,
    row_number: str | Column,
) -> DataFrame:
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    at = ingested_at if isinstance(ingested_at, Column) else F.lit(str(ingested_at))
    number = F.col(row_number) if isinstance(row_number, str) else row_number
    return df.select(
        *spec.payload,
        F.lit(spec.name).alias("_source_name"),
        batch.alias("_batch_id"),
        at.cast("timestamp_ntz").alias("_ingested_at"),
        F.lit(spec.source_ref).alias("_source_file"),
        number.cast("bigint").alias("_source_row_number"),
    )


def parse_json_lines(lines: DataFrame, payload: T.StructType, line_column: str = "value") -> DataFrame:
    """Parse JSON object lines. Blank lines vanish; a line that is not exactly one JSON object gets
    ``_malformed = true`` and NULL payload. Never raises on bad text.

    The parser stops at the end of the first value and would let text behind it pass. So each line is
    parsed as the only element of an array, in a document with one more field behind the array, and both
    must come out. ``lines`` keeps its other columns; nested values land as JSON text.
    """
    kept = [c for c in lines.columns if c != line_column]
    parsed = json_document(F.concat(F.lit("["), F.col("_line"), F.lit("]")), payload)
    fields = [F.col("_records")[0][f.name] for f in payload.fields]
    return (
        lines.select(*kept, F.trim(F.col(line_column), F.lit(WHITESPACE)).alias("_line"))
        .where(F.col("_line") != "")
        # Spark would copy a parsing expression into every filter above it. It does not move filters
        # below a generator, so each line is parsed once.
        .select(*kept, "_line", F.inline(F.array(parsed)))
        .withColumn("_malformed", ~is_complete(F.col("_records"), F.col("_end")) | (F.size("_records") != 1) | ~F.col("_line").startswith("{"))
        .select(
            *kept, "_line", "_malformed",
            *[F.when(~F.col("_malformed"), field).alias(f.name) for f, field in zip(payload.fields, fields)],
        )
    )


_STRICT = {"mode": "PERMISSIVE", "allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def json_document(array: Column, payload: T.StructType) -> Column:
    """A JSON array of objects, as text, parsed to ``_records`` and ``_end``; ``is_complete`` tells whether
    all of the text is that array."""
    schema = T.StructType([T.StructField("_records", T.ArrayType(payload)), T.StructField("_end", T.BooleanType())])
    return F.from_json(F.concat(F.lit('{"_records":'), array, F.lit(',"_end":true}')), schema, _STRICT)


def is_complete(records: Column, end: Column) -> Column:
    return F.coalesce(end, F.lit(False)) & records.isNotNull() & ~F.exists(F.coalesce(records, F.array()), lambda r: r.isNull())


def above_mark(df: DataFrame, field: str, mark: str | None) -> DataFrame:
    """Rows without a watermark value, and rows newer than the stored mark. Text comparison, which
    suits ISO-uniform values only. ``mark=None`` keeps everything."""
    return df if mark is None else df.where(is_above_mark(field, mark))


def is_above_mark(field: str, mark: str | None) -> Column:
    if mark is None:
        return F.lit(True)
    return F.col(field).isNull() | (F.col(field) > F.lit(mark))


def flag_known_keys(df: DataFrame, key: str, known: DataFrame, known_key: str, flag: str) -> DataFrame:
    """Adds a boolean: does ``key`` occur in ``known``? NULL never does.

    One outer join against distinct keys answers kept and rejected alike, so the input is read once.
    Rows without a key probe with a value of their own that matches nothing, so that they do not all
    meet in one task.
    """
    keys = _known_keys(known.where(F.col(known_key).isNotNull()), known_key)
    no_key = F.concat(F.lit("\u0000"), F.xxhash64(*df.columns).cast("string"))
    return (
        df.withColumn("_probe", F.coalesce(F.col(key).cast("string"), no_key))
        .join(keys, F.col("_probe") == F.col("_known_key"), "left")
        .withColumn(flag, F.col("_known_key").isNotNull())
        .drop("_probe", "_known_key")
    )


def _known_keys(known: DataFrame, known_key: str) -> DataFrame:
    return distinct_keys(known.select(F.col(known_key).cast("string").alias("_known_key")), ["_known_key"])


def fk_kept(df: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    keys = _known_keys(known, known_key)
    return df.join(keys, F.col(key) == F.col("_known_key"), "left_semi")


def fk_rejected(df: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    keys = _known_keys(known, known_key)
    return df.join(keys, F.col(key) == F.col("_known_key"), "left_anti")


def malformed_entries(parsed: DataFrame, file: str, number: str) -> DataFrame:
    return parsed.where("_malformed").select(
        F.col(file).alias("source_file"),
        F.col(number).cast("bigint").alias("source_row_number"),
        F.lit(MALFORMED).alias("reason"),
        F.lit("line is not a JSON object").alias("error_detail"),
        F.col("_line").alias("raw_record"),
    )


def rejected_entries(rejected: DataFrame, spec: SourceSpec, number: str, key: str = "customer_id") -> DataFrame:
    shown = F.coalesce(F.col(key), F.lit("None"))
    return rejected.select(
        F.lit(spec.name).alias("source_file"),
        F.col(number).cast("bigint").alias("source_row_number"),
        F.lit(UNKNOWN_CUSTOMER).alias("reason"),
        F.concat(F.lit(f"{key} "), shown, F.lit(" not present in raw.customers")).alias("error_detail"),
        F.to_json(F.struct(*spec.payload)).alias("raw_record"),
    )


def count_by_reason(quarantine: DataFrame) -> DataFrame:
    return quarantine.groupBy("reason").agg(F.count(F.lit(1)).alias("quarantined"))
