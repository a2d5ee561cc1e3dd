"""Ingestion runs of sources in each shape: what is loaded, rejected, skipped and replaced, and what a failure leaves."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators import intake
from tidemark.operators.quality import table_checksum
from tidemark.plans import ingest
from tidemark.schemas import SOURCES
from tidemark.sources import files, relational
from tidemark.sources.store import RawStore

RETURNS, ORDERS, REGIONS, PRODUCTS, PAYMENTS = (SOURCES[n] for n in ("returns", "orders", "regions", "products", "payments"))
AT = "2019-03-05 06:07:08"


def returned(key, day, item="I-7", **more):
    return json.dumps({"return_id": key, "order_item_id": item, "returned_at": f"2019-02-{day:02d}", "reason": "damaged", "quantity": 2, **more})


def placed(key, customer, minute):
    return json.dumps({"order_id": key, "customer_id": customer, "updated_at": f"2019-02-01T00:{minute:02d}:00Z"})


@pytest.fixture()
def store(spark, tmp_path):
    return RawStore(spark, str(tmp_path / "raw"))


@pytest.fixture()
def drop(spark, store, write_lines, tmp_path):
    """Add a file to a source's folder and run the source over the folder."""
    def run(spec, name, batch, *lines, at=AT, **kwargs):
        if lines:
            write_lines(f"{spec.name}/{name}", *lines)
        return ingest.run_ndjson(store, spec, files.scan_ndjson_lines(spark, str(tmp_path / spec.name)), batch, at, **kwargs)

    return run


def held(store, spec, *columns):
    return sorted(tuple(r) for r in store.raw(spec).select(*columns).collect())


def test_what_a_line_lacks_decides_where_it_goes(spark, store, drop):
    known = spark.createDataFrame([("north",), (None,)], "customer_id string")
    lines = [placed("p1", "north", 1), placed("p2", "south", 9), placed("p3", None, 2), placed("p4", "north", 3) + " tail", "{'order_id':'p5'}", "", '{"order_id":"' + "z" * 5000]
    stats = drop(ORDERS, "a.ndjson", "first", *lines, known_customers=known)
    assert (stats["extracted"], stats["loaded"], stats["quarantined"]) == (3, 1, 5)
    rejects = {r.source_row_number: r for r in store.quarantine(ORDERS).collect()}
    assert {n: r.reason for n, r in rejects.items()} == {2: intake.UNKNOWN_CUSTOMER, 3: intake.UNKNOWN_CUSTOMER, 4: intake.MALFORMED, 5: intake.MALFORMED, 7: intake.MALFORMED}
    assert rejects[7].raw_record == lines[6] and json.loads(rejects[2].raw_record)["customer_id"] == "south"
    # A row whose customer is unknown has been seen all the same.
    assert store.mark(ORDERS) == "2019-02-01T00:09:00Z"


def test_only_what_is_newer_than_the_mark_is_loaded_again(store, drop):
    drop(RETURNS, "1.ndjson", "one", returned("r1", 3), returned("r2", 4), returned("r3", 4))
    stats = drop(RETURNS, "2.ndjson", "two", returned("r2", 6, quantity=1), returned("r4", 4), returned("r5", 5))
    assert (stats["skipped_replayed"], stats["loaded"], stats["duplicates_vs_existing_batches"], stats["duplicates_in_batch"]) == (4, 2, 1, 0)
    assert held(store, RETURNS, "return_id", "quantity", "_batch_id") == [
        ("r1", "2", "one"), ("r2", "1", "two"), ("r2", "2", "one"), ("r3", "2", "one"), ("r5", "2", "two")
    ]
    idle = drop(RETURNS, "", "three")
    assert (idle["extracted"], idle["skipped_replayed"], idle["watermark_advanced"]) == (0, 6, False)
    assert sorted(r.batch_id for r in store.lineage().collect()) == ["one", "two"]


def test_a_full_run_under_an_old_id_takes_its_place(store, drop):
    drop(RETURNS, "1.ndjson", "b", *[returned(f"r{n}", n, item=f"I-{n}") for n in range(1, 8)])
    assert drop(RETURNS, "", "b")["loaded"] == 0 and store.raw(RETURNS).count() == 7
    stats = drop(RETURNS, "", "b", full=True, at="2019-03-06 00:00:00")
    assert (stats["loaded"], stats["replaced_prior_rows"], store.raw(RETURNS).count()) == (7, 7, 7)
    assert [(r.run_mode, str(r.ingested_at)) for r in store.lineage().collect()] == [("full", "2019-03-06 00:00:00")]


def test_nothing_moves_when_a_run_breaks(spark, store, drop, write_lines, tmp_path):
    drop(RETURNS, "1.ndjson", "one", returned("r1", 3))
    before = held(store, RETURNS, *RETURNS.payload), store.mark(RETURNS), store.lineage().count()
    write_lines("returns/2.ndjson", returned("r2", 8), returned("r3", 9))
    parsed = intake.parse_json_lines(files.scan_ndjson_lines(spark, str(tmp_path / "returns")), RETURNS.payload_schema)
    torn = parsed.withColumn("reason", F.when(F.col("return_id") == "r3", F.raise_error(F.lit("disk gone"))).otherwise(F.col("reason")))
    with pytest.raises(Exception, match="disk gone"):
        ingest.run_records(store, RETURNS, torn, "two", AT)
    assert before == (held(store, RETURNS, *RETURNS.payload), store.mark(RETURNS), store.lineage().count())
    assert drop(RETURNS, "", "two")["loaded"] == 2 and store.mark(RETURNS) == "2019-02-09"


def test_csv_snapshots_replace_each_other(spark, store, write_lines):
    def run(batch, *regions):
        path = write_lines(f"{batch}.csv", "country,region_id,region_name", *[f"X,{r},Name of {r}" for r in regions])
        return ingest.run_records(store, REGIONS, files.scan_csv(spark, path, REGIONS), batch, AT)

    assert run("s1", "u", "v")["loaded"] == 2
    checksum = table_checksum(store.raw(REGIONS), REGIONS.payload).first()
    assert run("s1", "u", "v")["replaced_prior_rows"] == 2
    assert table_checksum(store.raw(REGIONS), REGIONS.payload).first() == checksum
    later = run("s2", "v", "w", "x")
    assert (later["replaced_prior_rows"], later["duplicates_vs_existing_batches"]) == (2, 1)
    assert held(store, REGIONS, "region_id") == [("v",), ("w",), ("x",)] and store.batches(REGIONS).count() == 3
    assert run("s3")["loaded"] == 0 and store.raw(REGIONS).count() == 3


def test_json_snapshots_run_whole_or_not_at_all(spark, store, write_lines):
    path = write_lines("d/1.json", json.dumps([{"product_id": "k1", "brand": None}, {"product_id": "k2", "name": "n"}]))
    stats = ingest.run_snapshot(store, PRODUCTS, files.scan_json_array(spark, path, PRODUCTS), "j1", AT)
    assert (stats["loaded"], stats["extracted"], stats["watermark_advanced"]) == (2, 2, False)
    error = write_lines("d/2.json", json.dumps({"detail": "try later"}))
    with pytest.raises(Exception, match="not a JSON array"):
        ingest.run_snapshot(store, PRODUCTS, files.scan_json_array(spark, error, PRODUCTS), "j2", AT)
    assert held(store, PRODUCTS, "product_id", "_source_row_number") == [("k1", 1), ("k2", 2)]


def test_relational_runs_read_above_the_mark(spark, store):
    def table(*rows):
        return spark.createDataFrame([(k, 9, n, f"2019-02-0{d} 10:00:00") for k, n, d in rows], "payment_id int, order_id int, amount_cents long, updated_at string").withColumn(
            "updated_at", F.col("updated_at").cast("timestamp_ntz")
        )

    first = ingest.run_relational(store, PAYMENTS, table((1, 500, 1), (2, 600, 2)), "q1", AT)
    assert (first["loaded"], first["max_observed_watermark"]) == (2, "2019-02-02 10:00:00")
    second = ingest.run_relational(store, PAYMENTS, table((1, 500, 1), (2, 650, 3), (3, 700, 2)), "q2", AT)
    assert (second["loaded"], second["duplicates_vs_existing_batches"]) == (1, 1)
    assert held(store, PAYMENTS, "payment_id", "amount_cents", "status") == [("1", "500", None), ("2", "600", None), ("2", "650", None)]
    assert relational.high_mark(store.raw(PAYMENTS), "updated_at").first()[0] == "2019-02-03 10:00:00"


def test_a_mark_only_rises_and_each_source_has_its_own(store):
    assert store.mark(PAYMENTS) is None
    assert [store.record_mark(PAYMENTS, value, f"x{n}", AT) for n, value in enumerate(["5", "4", "5", "6"])] == [True, False, False, True]
    assert store.record_mark(RETURNS, "1", "y", AT) and (store.mark(PAYMENTS), store.mark(RETURNS)) == ("6", "1")


def test_rejects_without_rows_leave_no_trace(spark, store):
    schema = "source_file string, source_row_number long, reason string, error_detail string, raw_record string"
    rows = spark.createDataFrame([("f", n, "why" if n % 2 else "other", "d", "r" * n) for n in range(1, 6)], schema)
    store.write_quarantine(rows, RETURNS, "w1", AT)
    store.write_quarantine(rows.limit(0), RETURNS, "w2", AT)
    assert dict(intake.count_by_reason(store.quarantine(RETURNS)).collect()) == {"why": 3, "other": 2}
    assert store.quarantine(ORDERS).count() == 0
