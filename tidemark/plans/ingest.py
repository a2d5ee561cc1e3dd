"""One ingestion run of one source."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import dedup, intake
from tidemark.schemas import SourceSpec
from tidemark.sources import relational
from tidemark.sources.files import FILE, ROW_NUMBER
from tidemark.sources.store import GATED, KEPT, MALFORMED, RawStore


def run_records(
    store: RawStore, spec: SourceSpec, records: DataFrame, batch_id: str, ingested_at: str,
    known_customers: DataFrame | None = None, full: bool = False,
) -> dict:
    """Load parsed records: filter by mark, gate foreign keys, write, then record lineage and mark.

    ``records``: the payload as text with ``source_file`` and ``source_row_number``, and for NDJSON also
    ``_malformed`` and ``_line``. Kept and rejected rows are committed by one write. The mark moves last, so
    a failure anywhere before leaves it, and a repeat of the same batch id replaces what the failed run
    wrote. All counts but ``skipped_replayed`` come from the written batch; where there is a mark to be
    above, that one is an aggregate of its own over the input, so that repeated tasks do not count twice.
    """
    # A repeat without rows leaves the batch's earlier ones in place; they are not this run's.
    run_id = uuid.uuid4().hex
    mark = store.mark(spec) if spec.watermark and not full else None
    if "_malformed" not in records.columns:
        records = records.withColumns({"_malformed": F.lit(False), "_line": F.lit(None).cast("string")})

    fresh = F.lit(True) if mark is None else intake.is_above_mark(spec.watermark, mark)
    skipped = ~F.col("_malformed") & ~fresh
    n_skipped = 0 if mark is None else records.where(skipped).count()
    rows = records.where(~skipped)

    if known_customers is not None:
        rows = intake.flag_known_keys(rows, "customer_id", known_customers, "customer_id", "_known")
    else:
        rows = rows.withColumn("_known", F.lit(True))

    outcome = F.when(F.col("_malformed"), MALFORMED).when(F.col("_known"), KEPT).otherwise(GATED)
    shown = F.coalesce(F.col("customer_id"), F.lit("None")) if known_customers is not None else F.lit("")
    landed = rows.withColumn("_outcome", outcome).select(
        *spec.payload,
        F.lit(spec.name).alias("_source_name"),
        F.lit(ingested_at).cast("timestamp_ntz").alias("_ingested_at"),
        F.lit(spec.source_ref).alias("_source_file"),
        F.col(ROW_NUMBER).cast("bigint").alias("_source_row_number"),
        F.col(FILE).alias("_origin_file"),
        F.when(F.col("_outcome") == MALFORMED, intake.MALFORMED)
        .when(F.col("_outcome") == GATED, intake.UNKNOWN_CUSTOMER).alias("_reject_reason"),
        F.when(F.col("_outcome") == MALFORMED, "line is not a JSON object")
        .when(
            F.col("_outcome") == GATED,
            F.concat(F.lit("customer_id "), shown, F.lit(" not present in raw.customers")),
        ).alias("_reject_detail"),
        F.when(F.col("_outcome") == MALFORMED, F.col("_line"))
        .when(F.col("_outcome") == GATED, F.to_json(F.struct(*spec.payload)))
        .alias("_reject_record"),
        "_outcome",
        F.lit(batch_id).alias("_batch_id"),
        F.lit(run_id).alias("_run_id"),
    )

    replaced = _rows_to_replace(store, spec, batch_id)
    store.write_batch(landed, spec)

    written = store.landed(spec).where(F.col("_batch_id") == batch_id)
    high = F.max(F.when(F.col("_outcome") != MALFORMED, F.col(spec.watermark))) if spec.watermark else F.lit(None)
    this_run = written.where(F.col("_run_id") == run_id)
    counts = this_run.agg(
        *[F.count_if(F.col("_outcome") == o).alias(o) for o in (KEPT, GATED, MALFORMED)],
        high.cast("string").alias("max_mark"),
    ).first()
    loaded, quarantined = counts[KEPT], counts[GATED] + counts[MALFORMED]
    extracted = counts[KEPT] + counts[GATED]

    kept = this_run.where(F.col("_outcome") == KEPT)
    others = store.raw(spec).where(F.col("_batch_id") != batch_id)
    keys = list(spec.natural_key)
    in_batch = dedup.duplicates_in_batch(kept, keys).first()[0]
    vs_existing = dedup.duplicates_vs_existing(kept, others, keys, lambda new: store.stage(new, run_id)).first()[0]

    if not spec.watermark and loaded:
        store.commit_snapshot(spec, batch_id, ingested_at)
        store.drop_superseded(spec)
    if loaded or quarantined:
        mode = "full" if full else ("incremental" if spec.watermark else "snapshot")
        store.record_lineage(
            spec, batch_id, ingested_at,
            {"rows_extracted": extracted, "rows_loaded": loaded, "rows_quarantined": quarantined}, mode,
        )
    advanced = False
    if spec.watermark and counts["max_mark"] is not None:
        advanced = store.record_mark(spec, counts["max_mark"], batch_id, ingested_at)

    return {
        "batch_id": batch_id, "source": spec.name, "extracted": extracted, "loaded": loaded,
        "replaced_prior_rows": replaced if loaded else 0, "quarantined": quarantined,
        "duplicates_in_batch": in_batch, "duplicates_vs_existing_batches": vs_existing,
        "skipped_replayed": n_skipped, "watermark_advanced": advanced,
        "max_observed_watermark": counts["max_mark"],
    }


def _rows_to_replace(store: RawStore, spec: SourceSpec, batch_id: str) -> int:
    """Rows the batch id already has; for a new snapshot, all rows of the one it supersedes."""
    current = store.raw(spec)
    own = current.where(F.col("_batch_id") == batch_id).count()
    if own or spec.watermark:
        return own
    return current.count()


def run_ndjson(store: RawStore, spec: SourceSpec, lines: DataFrame, batch_id: str, ingested_at: str, **kwargs) -> dict:
    """``lines``: value, source_file, source_row_number."""
    return run_records(
        store, spec, intake.parse_json_lines(lines, spec.payload_schema), batch_id, ingested_at, **kwargs
    )


def run_snapshot(store: RawStore, spec: SourceSpec, records: DataFrame, batch_id: str, ingested_at: str, **kwargs) -> dict:
    """A source without a mark, read whole each time (CSV files, JSON documents): the new snapshot replaces the
    one before. ``records``: the payload with source_file and source_row_number."""
    if spec.watermark:
        raise ValueError(f"{spec.name} is loaded by increments")
    return run_records(store, spec, intake.project_payload(records, spec, (FILE, ROW_NUMBER)), batch_id, ingested_at, **kwargs)


def run_relational(
    store: RawStore, spec: SourceSpec, table: DataFrame, batch_id: str, ingested_at: str, full: bool = False, **kwargs
) -> dict:
    """A relational table with native types: columns and mark filter reach the table, rows land as text.
    Rows without a mark value are read every time. They have no place in a file and no number."""
    mark = None if full else store.mark(spec)
    present = [c for c in spec.payload if c in table.columns]
    rows = relational.as_text(relational.increment(table, present, spec.watermark, mark, with_unmarked=True))
    located = intake.project_payload(rows, spec).withColumns({FILE: F.lit(spec.source_ref), ROW_NUMBER: F.lit(None).cast("bigint")})
    return run_records(store, spec, located, batch_id, ingested_at, full=full, **kwargs)
