"""The rows of a streamed batch are dealt out evenly before the newest of each key are chosen."""

from pyspark.sql import functions as F

from tidemark.sources.tables import ManifestTable
from tidemark.streaming import jobs


def test_a_large_file_and_a_hot_key_are_dealt_out(spark, tmp_path, monkeypatch):
    rows = spark.range(4000).select(
        F.when(F.col("id") < 3000, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").cast("string").alias("at"), F.lit("x").alias("part")
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/in")
    shares, real = [], jobs.latest_by_key

    def watched(df, *args, **kwargs):
        shares.extend(r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect())
        return real(df, *args, **kwargs)

    monkeypatch.setattr(jobs, "latest_by_key", watched)
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(setting, "false")
    try:
        stream = spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in")
        jobs.upsert_stream(stream, f"{tmp_path}/t", ["k"], "at", "part", f"{tmp_path}/c").awaitTermination()
    finally:
        spark.conf.unset(setting)
    assert sum(shares) == 4000 and max(shares) < 2000
    table = ManifestTable(spark, f"{tmp_path}/t").read()
    assert table.count() == 1001 and table.where("k = 'hot'").first()["at"] == "999"
