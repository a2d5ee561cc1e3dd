import random

from tidemark.operators import dedup

SCHEMA = "k string, at string, _batch_id string, _source_file string, _source_row_number long"


def test_newest_row_wins_whatever_the_input_order(spark, rows):
    data = [("a", "2026-01-01", "1", "f", 1), ("a", "2026-01-02", "1", "f", 2), ("b", "2026-01-01", "1", "f", 3),
            ("a", "2026-01-02", "2", "f", 1), (None, "2026-01-01", "1", "f", 9), (None, "2026-01-03", "1", "f", 8)]
    results = []
    for seed in range(3):
        random.Random(seed).shuffle(data)
        results.append(rows(dedup.latest_by_key(spark.createDataFrame(data, SCHEMA), ["k"], "at")))
    assert results[0] == results[1] == results[2]
    assert {(r[0], r[2], r[4]) for r in results[0]} == {("a", "2", 1), ("b", "1", 3), (None, "1", 8)}


def test_hot_key_is_reduced_before_the_exchange(spark):
    hot = spark.range(6000).selectExpr(
        "if(id % 3 = 0, 'hot', cast(id as string)) k", "cast(id as string) at", "'b' _batch_id", "'f' _source_file",
        "id _source_row_number",
    )
    latest = dedup.latest_by_key(hot, ["k"], "at")
    assert latest.count() == 4001
    plan = latest._jdf.queryExecution().toString()
    partial, final = plan.rindex("row_number(), 1, Partial"), plan.rindex("row_number(), 1, Final")
    assert final < plan.rindex("Exchange hashpartitioning") < partial  # printed from the result downwards


def test_duplicate_counts_treat_null_keys_as_equal(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), (None, 1), ("b", 2)], "k string, n int")
    stored = spark.createDataFrame([("a", 1), ("a", 1), (None, 1), ("z", 3)], "k string, n int")
    assert dedup.duplicates_in_batch(batch, ["k"]).first()[0] == 2
    assert dedup.duplicates_vs_existing(batch, stored, ["k", "n"]).first()[0] == 4
    assert dedup.duplicates_in_batch(batch.where("false"), ["k"]).first()[0] == 0
    assert {tuple(r) for r in dedup.repeated_keys(batch, ["k"]).collect()} == {("a", 2), (None, 2)}
