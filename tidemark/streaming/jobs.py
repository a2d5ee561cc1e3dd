"""Daily drops and late facts as streams. All of them run with ``availableNow``: what is there is processed,
then the query ends; the checkpoint remembers what has been seen."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tidemark.operators import intake
from tidemark.operators.dedup import latest_by_key
from tidemark.schemas import LOOKBACK_DAYS, SourceSpec
from tidemark.sources.commits import CommitLog
from tidemark.sources.store import KEPT, MALFORMED, RawStore, write_partitions
from tidemark.sources.tables import ManifestTable


def _state_on_disk(spark: SparkSession) -> None:
    """Keyed state outgrows the heap, so it is kept in RocksDB unless the session says otherwise."""
    setting = "spark.sql.streaming.stateStore.providerClass"
    if "RocksDB" not in spark.conf.get(setting, ""):
        spark.conf.set(setting, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def ingest_ndjson(
    spark: SparkSession, folder: str, spec: SourceSpec, store: RawStore, checkpoint: str,
    max_files: int | None = None,
) -> StreamingQuery:
    """New NDJSON files into the raw table, bad lines into quarantine. A file is read once, ever.

    Each micro-batch is one write, under a batch id made of its number: a batch that is replayed after
    a failure replaces its own rows. Lines carry their file but no number, since numbering takes a second
    pass over the file.
    """
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(folder).select("value", F.col("_metadata.file_path").alias("source_file"))

    def land(batch: DataFrame, number: int) -> None:
        parsed = intake.parse_json_lines(batch, spec.payload_schema)
        bad = F.col("_malformed")
        store.write_batch(
            parsed.select(
                *spec.payload,
                F.lit(spec.name).alias("_source_name"),
                F.current_timestamp().cast("timestamp_ntz").alias("_ingested_at"),
                F.lit(spec.source_ref).alias("_source_file"),
                F.lit(None).cast("bigint").alias("_source_row_number"),
                F.col("source_file").alias("_origin_file"),
                F.when(bad, intake.MALFORMED).alias("_reject_reason"),
                F.when(bad, "line is not a JSON object").alias("_reject_detail"),
                F.when(bad, F.col("_line")).alias("_reject_record"),
                F.when(bad, MALFORMED).otherwise(KEPT).alias("_outcome"),
                F.lit(f"stream-{number:010d}").alias("_batch_id"),
            ),
            spec,
        )

    return (
        lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def without_replays(
    stream: DataFrame, keys: list[str], event_time: str, days: int = LOOKBACK_DAYS, spread: Column | None = None
) -> DataFrame:
    """Drop repeats of a key that arrive within ``days`` of event time. ``event_time`` must be a
    TIMESTAMP: event-time watermarks do not take TIMESTAMP_NTZ.

    ``spread`` (say, a hash of the input file) adds a first pass that drops repeats per key *and* spread
    value, so that the copies of one hot key are thinned out in many tasks before they meet in one.
    """
    marked = stream.withWatermark(event_time, f"{days} days")
    if spread is not None:
        marked = marked.withColumn("_spread", spread).dropDuplicatesWithinWatermark([*keys, "_spread"]).drop("_spread")
    return marked.dropDuplicatesWithinWatermark(keys)


def daily_counts(events: DataFrame, event_time: str, value: str, by: str, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows and value per day and group; on a stream, a day closes ``days`` after it. Values are summed in
    whole cents, so that the order of arrival does not show in the sums."""
    day = F.window(event_time, "1 day")
    timely = events.withWatermark(event_time, f"{days} days") if events.isStreaming else events
    return (
        timely.groupBy(day.alias("_day"), by)
        .agg(F.count(F.lit(1)).alias("events"), F.sum(F.round(F.col(value) * 100).cast("bigint")).alias("value_cents"))
        .select(F.col("_day.start").cast("date").alias("day"), by, "events", "value_cents")
    )


def split_late(
    stream: DataFrame, event_time: str, path: str, checkpoint: str, days: int = LOOKBACK_DAYS
) -> StreamingQuery:
    """Rows that come behind the watermark are kept apart instead of being dropped: every row of the stream is in exactly
    one of ``on_time`` and ``late``.

    A batch's watermark is the latest event time of the batches before it, less ``days``. A row without an event time has no
    window to go to and counts as late. A batch is written in one pass, under its number, and its latest time noted
    down after that, so a batch that is replayed meets the same watermark and replaces its own rows.
    """
    marks = CommitLog(stream.sparkSession, f"{checkpoint}/marks")

    def divide(batch: DataFrame, number: int) -> None:
        before = marks.read(number)["latest"] if number else None  # entry n is that of batch n - 1
        at = F.col(event_time)
        mark = F.lit(before).cast(batch.schema[event_time].dataType) - F.make_dt_interval(F.lit(days))
        seen = Observation()
        watched = batch.observe(seen, F.max(at).cast("string").alias("latest"))
        write_partitions(
            watched.withColumns({_LATE: F.coalesce(at < mark, at.isNull()), _BATCH: F.lit(number).cast("bigint")}), path, _LATE, _BATCH
        )
        latest = seen.get["latest"]
        if latest is None or (before is not None and not _is_after(batch.sparkSession, latest, before)):
            latest = before
        marks.create(number + 1, {"latest": latest})

    return (
        stream.writeStream.foreachBatch(divide).option("checkpointLocation", f"{checkpoint}/stream")
        .trigger(availableNow=True).start()
    )


_LATE, _BATCH = "_late", "_batch"


def _is_after(spark: SparkSession, one: str, other: str) -> bool:
    return spark.range(1).select(F.lit(one).cast("timestamp_ntz") > F.lit(other).cast("timestamp_ntz")).first()[0]


def on_time(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return _split_rows(spark, path, schema, False)


def late(spark: SparkSession, path: str, schema: StructType, since: int | None = None) -> DataFrame:
    """Late rows, of batches after number ``since`` alone if given: what a later run has still to merge."""
    rows = _split_rows(spark, path, schema, True)
    return rows if since is None else rows.where(F.col(_BATCH) > since)


def _split_rows(spark: SparkSession, path: str, schema: StructType, is_late: bool) -> DataFrame:
    stored = StructType([*schema.fields, StructField(_LATE, BooleanType()), StructField(_BATCH, LongType())])
    return spark.read.schema(stored).parquet(path).where(F.col(_LATE) == is_late).drop(_LATE)


def upsert_stream(
    stream: DataFrame, path: str, keys: list[str], order_by: str, partition: str, checkpoint: str
) -> StreamingQuery:
    """Merge each micro-batch into a partitioned fact: the newest row per key of batch and table stays,
    whatever the order in which versions arrive. Of rows alike in ``order_by`` the batch's wins, within a
    batch the one with the greatest remaining columns. A replayed batch merges the same rows again, to no
    effect."""
    tiebreak = tuple(c for c in stream.columns if c not in (*keys, order_by))

    def merge(batch: DataFrame, number: int) -> None:
        # Dealt out by whole rows first, so that the sorts that choose the newest rows get tasks of an even size and not whole
        # row groups of large files, and a key with many versions does not meet in one task.
        newest = latest_by_key(batch.repartition(*batch.columns), keys, order_by, tiebreak=tiebreak)
        ManifestTable(batch.sparkSession, path, tuple(keys), (partition,)).merge(newest, order_by=order_by)

    return (
        stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def append_to(stream: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None) -> StreamingQuery:
    """``state_partitions`` is fixed by a checkpoint's first run; the session's shuffle setting without it."""
    spark = stream.sparkSession
    _state_on_disk(spark)
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(state_partitions or before))
    try:
        return (
            stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start()
        )
    finally:
        spark.conf.set(setting, before)
