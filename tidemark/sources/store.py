"""The raw layer on files: batches, rejects, lineage and marks.

Loaded and rejected rows of a source share one parquet table, partitioned by outcome and batch id: one job
reads the input once and commits both together. The raw table and the quarantine table are views on it
that prune to their partitions.

Everything is written with dynamic partition overwrite. A batch that is run again replaces its own
partitions, an empty one touches nothing, and a write either commits as a whole or leaves the earlier
state. Marks and commits are histories; the current state is an aggregate over them, so a repeated or
late entry cannot lower it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.schemas import METADATA, SourceSpec

KEPT, GATED, MALFORMED = "kept", "gated", "malformed"

_META = "_source_name string, _ingested_at timestamp_ntz, _source_file string, _source_row_number bigint"
# Names of their own, since a payload may hold a "reason" too.
_REJECT = "_origin_file string, _reject_reason string, _reject_detail string, _reject_record string, _run_id string"
_PARTITIONS = "_outcome string, _batch_id string"
_LINEAGE = (
    "source_ref string, target_raw_table string, ingested_at timestamp_ntz, rows_extracted bigint, "
    "rows_loaded bigint, rows_quarantined bigint, run_mode string, source_name string, batch_id string"
)
_MARKS = (
    "watermark_field string, watermark_value string, advanced_at timestamp_ntz, source_name string, "
    "last_batch_id string"
)
_COMMITS = "committed_at timestamp_ntz, run_no bigint, source_name string, batch_id string"


def write_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Replace the partitions that occur in ``df``, and no others. Rebalanced, so that a partition gets few
    files of an even size, a large one several."""
    (
        df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by).parquet(path)
    )


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The stored rows, or none where nothing was written yet."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.read.schema(declared).parquet(path)
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in declared.fields])


@dataclass(frozen=True)
class RawStore:
    spark: SparkSession
    root: str

    def _at(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    def stage(self, df: DataFrame, run_id: str) -> DataFrame:
        """A small intermediate of one run, written and read back."""
        path = self._at("runs", run_id)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # Raw batches and rejects

    def write_batch(self, rows: DataFrame, spec: SourceSpec) -> None:
        """``rows``: payload and metadata of one or more batches; where rejects are among them, also
        ``_outcome`` and the reject columns."""
        missing = {f.name: f.dataType for f in T.StructType.fromDDL(_REJECT) if f.name not in rows.columns}
        full = rows.withColumns({c: F.lit(None).cast(t) for c, t in missing.items()})
        if "_outcome" not in rows.columns:
            full = full.withColumn("_outcome", F.lit(KEPT))
        write_partitions(full.select(*self._schema(spec).fieldNames()), self._landing(spec), "_outcome", "_batch_id")

    def _landing(self, spec: SourceSpec) -> str:
        return self._at("landing", spec.name)

    @staticmethod
    def _schema(spec: SourceSpec) -> T.StructType:
        extra = T.StructType.fromDDL(f"{_META}, {_REJECT}, {_PARTITIONS}")
        return T.StructType([*spec.payload_schema.fields, *extra.fields])

    def landed(self, spec: SourceSpec) -> DataFrame:
        return read_or_empty(self.spark, self._landing(spec), self._schema(spec))

    def batches(self, spec: SourceSpec) -> DataFrame:
        """All loaded batches, superseded snapshots included."""
        return self.landed(spec).where(F.col("_outcome") == KEPT).select(*spec.payload, *METADATA)

    def raw(self, spec: SourceSpec) -> DataFrame:
        """What the source's raw table holds: every batch of an incremental source, but only the last
        committed snapshot of one without a watermark."""
        stored = self.batches(spec)
        if spec.watermark:
            return stored
        last = self.current_snapshot(spec)
        return stored.where(F.col("_batch_id") == F.lit(last)) if last else stored.where("false")

    def write_quarantine(self, entries: DataFrame, spec: SourceSpec, batch_id: str, at: str) -> None:
        """Rejects alone. An empty input writes nothing."""
        rows = entries.select(
            *[F.lit(None).cast("string").alias(c) for c in spec.payload],
            F.lit(spec.name).alias("_source_name"), F.lit(at).cast("timestamp_ntz").alias("_ingested_at"),
            F.lit(spec.source_ref).alias("_source_file"), F.col("source_row_number").alias("_source_row_number"),
            F.col("source_file").alias("_origin_file"), F.col("reason").alias("_reject_reason"),
            F.col("error_detail").alias("_reject_detail"), F.col("raw_record").alias("_reject_record"),
            F.when(F.col("reason") == "malformed_json", MALFORMED).otherwise(GATED).alias("_outcome"),
            F.lit(batch_id).alias("_batch_id"),
        )
        self.write_batch(rows, spec)

    def quarantine(self, spec: SourceSpec) -> DataFrame:
        return self.landed(spec).where(F.col("_outcome") != KEPT).select(
            F.col("_origin_file").alias("source_file"), F.col("_source_row_number").alias("source_row_number"),
            F.col("_reject_reason").alias("reason"), F.col("_reject_detail").alias("error_detail"),
            F.col("_reject_record").alias("raw_record"), "_source_name", "_batch_id", "_ingested_at",
        )

    # Snapshot commits

    def commit_snapshot(self, spec: SourceSpec, batch_id: str, at: str) -> None:
        """Make a written snapshot the current one. Until then readers see the previous one."""
        commits = read_or_empty(self.spark, self._at("commits"), _COMMITS)
        next_no = (commits.where(F.col("source_name") == spec.name).agg(F.max("run_no")).first()[0] or 0) + 1
        row = self.spark.range(1).select(
            F.lit(at).cast("timestamp_ntz").alias("committed_at"), F.lit(next_no).cast("bigint").alias("run_no"),
            F.lit(spec.name).alias("source_name"), F.lit(batch_id).alias("batch_id"),
        )
        write_partitions(row, self._at("commits"), "source_name", "batch_id")

    def current_snapshot(self, spec: SourceSpec) -> str | None:
        commits = read_or_empty(self.spark, self._at("commits"), _COMMITS)
        own = commits.where(F.col("source_name") == spec.name)
        return own.agg(F.max_by("batch_id", "run_no")).first()[0]

    def drop_superseded(self, spec: SourceSpec) -> None:
        """Remove snapshot batches that are no longer current."""
        last = self.current_snapshot(spec)
        jvm = self.spark._jvm
        folder = jvm.org.apache.hadoop.fs.Path(f"{self._landing(spec)}/_outcome={KEPT}")
        fs = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if last is None or not fs.exists(folder):
            return
        for status in fs.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith("_batch_id=") and name != f"_batch_id={last}":
                fs.delete(status.getPath(), True)

    # Lineage: one row per (batch, source); a rerun replaces its own

    def record_lineage(self, spec: SourceSpec, batch_id: str, at: str, counts: dict[str, int], mode: str) -> None:
        values = {**counts, "batch_id": batch_id, "ingested_at": at, "run_mode": mode}
        row = self.spark.range(1).select(*[F.lit(v).alias(c) for c, v in values.items()])
        self.record_lineage_of(spec, row)

    def record_lineage_of(self, spec: SourceSpec, batches: DataFrame) -> None:
        """``batches``: one row per batch, with its id, time, counts and mode."""
        rows = batches.withColumns({
            "source_ref": F.lit(spec.source_ref), "target_raw_table": F.lit(f"raw.{spec.name}"),
            "source_name": F.lit(spec.name),
        })
        declared = T.StructType.fromDDL(_LINEAGE)
        write_partitions(
            rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in declared.fields]),
            self._at("lineage"), "source_name", "batch_id",
        )

    def lineage(self) -> DataFrame:
        return read_or_empty(self.spark, self._at("lineage"), _LINEAGE)

    # Watermarks

    def record_mark(self, spec: SourceSpec, value: str, batch_id: str, at: str) -> bool:
        """Add a mark; True when it is above all earlier ones."""
        before = self.mark(spec)
        if before is not None and value <= before:
            return False
        row = self.spark.range(1).select(
            F.lit(spec.watermark).alias("watermark_field"), F.lit(value).alias("watermark_value"),
            F.lit(at).cast("timestamp_ntz").alias("advanced_at"),
            F.lit(spec.name).alias("source_name"), F.lit(batch_id).alias("last_batch_id"),
        )
        write_partitions(row, self._at("watermarks"), "source_name", "last_batch_id")
        return True

    def marks(self) -> DataFrame:
        """The current mark per source."""
        return current_marks(read_or_empty(self.spark, self._at("watermarks"), _MARKS))

    def mark(self, spec: SourceSpec) -> str | None:
        row = self.marks().where(F.col("source_name") == spec.name).select("watermark_value").first()
        return row[0] if row else None


def current_marks(history: DataFrame) -> DataFrame:
    latest = F.max(F.struct("watermark_value", "advanced_at", "watermark_field", "last_batch_id")).alias("m")
    return history.groupBy("source_name").agg(latest).select(
        "source_name", "m.watermark_field", "m.watermark_value", "m.advanced_at", "m.last_batch_id"
    )

