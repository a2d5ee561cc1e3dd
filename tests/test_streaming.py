import json

from pyspark.sql import functions as F

from tidemark.schemas import SOURCES
from tidemark.sources.store import RawStore
from tidemark.sources.tables import ManifestTable
from tidemark.streaming import jobs

RETURNS = SOURCES["returns"]


def line(key):
    return json.dumps({"return_id": key, "order_item_id": "I1", "returned_at": "2026-01-01", "reason": "damaged", "quantity": 1})


def test_new_files_only(spark, write_lines, tmp_path):
    store = RawStore(spark, str(tmp_path / "store"))

    def run():
        jobs.ingest_ndjson(spark, str(tmp_path / "in"), RETURNS, store, str(tmp_path / "cp")).awaitTermination()
        return store.raw(RETURNS).count(), store.quarantine(RETURNS).count()

    write_lines("in/dt=1.ndjson", line("R1"), "garbage", "")
    assert run() == (1, 1)
    assert run() == (1, 1)
    write_lines("in/dt=2.ndjson", line("R2"), line("R1"), '{"return_id"')
    assert run() == (3, 2)
    assert {r._batch_id for r in store.raw(RETURNS).collect()} == {"stream-0000000000", "stream-0000000001"}


def test_dedup_across_runs_and_lateness(spark, tmp_path, rows):
    def put(n, *events):
        spark.createDataFrame(list(events), "k string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in" / f"f{n}"))

    def run(spread):
        stream = spark.readStream.schema("k string, ts timestamp").parquet(str(tmp_path / "in" / "*"))
        salt = F.pmod(F.xxhash64("_metadata.file_path"), F.lit(4)) if spread else None
        unique = jobs.without_replays(stream, ["k"], "ts", spread=salt)
        jobs.append_to(unique, str(tmp_path / f"out{spread}"), str(tmp_path / f"cp{spread}")).awaitTermination()
        return rows(spark.read.parquet(str(tmp_path / f"out{spread}")).select("k"))

    put(1, ("a", "2026-01-01 00:00:00"), ("a", "2026-01-01 00:00:00"), ("b", "2026-01-02 00:00:00"))
    assert run(False) == run(True) == [("a",), ("b",)]
    put(2, ("b", "2026-01-02 00:00:00"), ("c", "2026-01-03 00:00:00"))
    assert run(False) == run(True) == [("a",), ("b",), ("c",)]


def test_daily_counts_stream_equals_batch(spark, tmp_path, rows):
    events = spark.range(500).selectExpr(
        "cast(timestamp'2026-01-01' + make_dt_interval(cast(id % 5 as int), 0, cast(id as int)) as timestamp) ts", "id % 3 as kind", "id / 7 as value"
    )
    events.write.parquet(str(tmp_path / "in"))
    later = "2026-03-01 00:00:00"
    events.limit(1).withColumn("ts", F.lit(later).cast("timestamp")).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    jobs.append_to(jobs.daily_counts(stream, "ts", "value", "kind"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == rows(jobs.daily_counts(events, "ts", "value", "kind"))


def test_upsert_over_runs(spark, tmp_path, rows):
    schema = "id string, month string, at string"

    def run(*changes):
        spark.createDataFrame(list(changes), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        jobs.upsert_stream(stream, str(tmp_path / "t"), ["id"], "at", "month", str(tmp_path / "cp")).awaitTermination()
        return rows(ManifestTable(spark, str(tmp_path / "t")).read().select("id", "month", "at"))

    assert run(("a", "m1", "1"), ("a", "m1", "2"), ("b", "m2", "1")) == [("a", "m1", "2"), ("b", "m2", "1")]
    assert run(("b", "m2", "5"), ("c", "m1", "1")) == [("a", "m1", "2"), ("b", "m2", "5"), ("c", "m1", "1")]
    # An older version that arrives later changes nothing, in its own partition or another.
    assert run(("a", "m1", "1"), ("b", "m3", "4"), ("c", "m1", "2")) == [("a", "m1", "2"), ("b", "m2", "5"), ("c", "m1", "2")]


def test_late_rows_are_kept_apart(spark, tmp_path, rows):
    schema = spark.sql("select '' k, cast(null as timestamp) ts").schema

    def run(n, *events):
        spark.createDataFrame(list(events), "k string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(str(tmp_path / "in" / f"f{n}"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in" / "*"))
        jobs.split_late(stream, "ts", str(tmp_path / "out"), str(tmp_path / "cp"), days=2).awaitTermination()
        return ["".join(sorted(r.k for r in read(spark, str(tmp_path / "out"), schema).collect())) for read in (jobs.on_time, jobs.late)]

    # Within the first batch nothing is late; a row without a time is.
    assert run(0, ("a", "2026-01-01"), ("b", "2026-01-10"), ("n", None)) == ["ab", "n"]
    # The watermark is 2026-01-08, also for rows beside a later one.
    assert run(1, ("c", "2026-01-07 23:59:59"), ("d", "2026-01-08"), ("e", "2026-01-20")) == ["abde", "cn"]
    # A batch of late rows alone leaves the watermark where it was.
    assert run(2, ("f", "2026-01-02"), ("g", None)) == ["abde", "cfgn"]
    assert run(3, ("h", "2026-01-17"), ("i", "2026-01-18")) == ["abdei", "cfghn"]
    assert rows(jobs.late(spark, str(tmp_path / "out"), schema, since=1).select("k")) == [("f",), ("g",), ("h",)]

    # The last batch once more, as after a failure before it was marked as done: nothing doubles.
    (tmp_path / "cp" / "stream" / "commits" / "3").unlink()
    (tmp_path / "cp" / "stream" / "commits" / ".3.crc").unlink(missing_ok=True)
    assert run(4, ("j", "2026-01-19")) == ["abdeij", "cfghn"]
