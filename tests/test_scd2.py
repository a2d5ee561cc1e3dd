import random

import pandas as pd
from pyspark.sql import functions as F

from tidemark.operators import joins, scd2
from tidemark.plans import checks, core
from tidemark.plans.history import VersionHistory

SOURCE = "customer_id string, city string, region_id string, updated_at timestamp_ntz"


def source(spark, *rows):
    return spark.createDataFrame([(k, c, r, pd.Timestamp(at).to_pydatetime()) for k, c, r, at in rows], SOURCE)


def start(spark, *rows):
    return scd2.open_versions(source(spark, *rows), "customer_id")


def spans(history):
    return sorted((r.customer_id, r.city, str(r.dbt_valid_from)[:10], r.dbt_valid_to and str(r.dbt_valid_to)[:10]) for r in history.collect())


def test_change_closes_and_opens(spark):
    history = start(spark, ("C1", "X", "R1", "2024-01-01"), ("C2", "Y", "R1", "2024-01-01"))
    after = scd2.snapshot(history, source(spark, ("C1", "Z", "R2", "2024-03-01"), ("C2", "Y", "R1", "2024-01-01"), ("C3", "W", "R1", "2024-02-01")), "customer_id", "2024-04-01")
    assert spans(after) == [
        ("C1", "X", "2024-01-01", "2024-03-01"), ("C1", "Z", "2024-03-01", None),
        ("C2", "Y", "2024-01-01", None), ("C3", "W", "2024-02-01", None),
    ]


def test_deleted_and_returned(spark):
    history = start(spark, ("C1", "X", "R1", "2024-01-01"))
    gone = scd2.snapshot(history, source(spark), "customer_id", "2024-04-01")
    assert spans(gone) == [("C1", "X", "2024-01-01", "2024-04-01")]
    kept = scd2.snapshot(history, source(spark), "customer_id", "2024-04-01", close_missing=False)
    assert spans(kept) == [("C1", "X", "2024-01-01", None)]
    back = scd2.snapshot(gone, source(spark, ("C1", "X", "R1", "2024-05-01")), "customer_id", "2024-06-01")
    assert spans(back)[1] == ("C1", "X", "2024-05-01", None)
    assert [r.issue for r in scd2.violations(back, "customer_id").collect()] == ["validity_gap"]


def test_older_or_equal_rows_change_nothing(spark):
    history = start(spark, ("C1", "X", "R1", "2024-02-01"))
    for at in ("2024-02-01", "2024-01-01"):
        again = scd2.snapshot(history, source(spark, ("C1", "Q", "R9", at)), "customer_id", "2024-04-01")
        assert spans(again) == spans(history)


def test_random_changes_keep_the_invariants(spark, tmp_path):
    rng, day = random.Random(7), 1
    state = {f"C{i}": ("X", pd.Timestamp("2024-01-01")) for i in range(30)}
    history = start(spark, *[(k, c, "R1", at) for k, (c, at) in state.items()])
    for step in range(4):
        for key in rng.sample(sorted(state), 12):
            state[key] = (rng.choice("ABC"), pd.Timestamp("2024-01-01") + pd.Timedelta(days=10 * (step + 1) + rng.randint(0, 5)))
        rows = source(spark, *[(k, c, "R1", at) for k, (c, at) in state.items()])
        history = scd2.snapshot(history, rows, "customer_id", "2025-01-01")
        history.write.parquet(str(tmp_path / f"h{step}"))
        history = spark.read.parquet(str(tmp_path / f"h{step}"))
    assert history.count() > 60
    assert scd2.violations(history, "customer_id").count() == 0
    assert scd2.structure_violations(history, "customer_id").count() == 0
    assert scd2.duplicate_versions(history, "customer_id").count() == 0
    assert scd2.snapshot(history, rows, "customer_id", "2025-02-01").count() == history.count()


def test_next_start_equals_plain_lead(spark):
    rng = random.Random(3)
    rows = [(f"C{rng.randint(0, 4)}", "X", "R1", pd.Timestamp("2024-01-01") + pd.Timedelta(hours=i * 7)) for i in rng.sample(range(3000), 300)]
    got = scd2.with_next_start(start(spark, *rows), "customer_id").toPandas().sort_values(["customer_id", "dbt_valid_from"])
    expected = got.groupby("customer_id")["dbt_valid_from"].shift(-1)
    assert len(got) == 300 and (got["next_valid_from"].fillna(0) == expected.fillna(0)).all()


def test_broken_history_is_reported(spark):
    stacked = start(spark, ("C1", "X", "R1", "2024-01-01"), ("C1", "Y", "R1", "2024-01-01"), ("C2", "Z", "R1", "2024-01-01"))
    assert {(r.issue, r.customer_id, r.detail) for r in scd2.violations(stacked, "customer_id").collect()} == {("multiple_current", "C1", "2")}
    assert scd2.duplicate_versions(stacked, "customer_id").count() == 2
    backwards = stacked.withColumn(scd2.VALID_TO, F.col(scd2.VALID_FROM))
    assert scd2.structure_violations(backwards, "customer_id").count() == 3


def test_as_of_picks_the_version_of_the_time(spark):
    history = scd2.snapshot(
        start(spark, ("C1", "X", "R1", "2024-01-01")), source(spark, ("C1", "Z", "R2", "2024-03-01")), "customer_id", "2024-04-01"
    )
    facts = spark.createDataFrame(
        [(n, "C1", pd.Timestamp(at).to_pydatetime()) for n, at in (("early", "2023-12-31"), ("first", "2024-01-01"), ("last", "2024-02-29"), ("edge", "2024-03-01"))],
        "order_id string, customer_id string, order_ts timestamp_ntz",
    )
    got = joins.as_of(facts, history.select("customer_id", "city", "dbt_valid_from", "dbt_valid_to"), "customer_id", "order_ts")
    assert {(r.order_id, r.city) for r in got.collect()} == {("first", "X"), ("last", "X"), ("edge", "Z")}


def test_one_version_check_sees_zero_and_many(spark):
    dim = spark.createDataFrame([("s1",), ("s2",), ("s2",)], "customer_sk string")
    orders = spark.createDataFrame([("a", "s1"), ("b", "s2"), ("c", "s9")], "order_id string, customer_sk string")
    assert {tuple(r) for r in checks.not_one_version(orders, dim).collect()} == {("b", 2), ("c", 0)}


def test_customer_source_has_one_row_per_key(spark):
    columns = ", ".join(f"'{c}' {c}" for c in core.CUSTOMER_ATTRIBUTES if c not in ("customer_id", "updated_at"))
    staged = spark.sql(f"select 'C1' customer_id, {columns}, updated_at, 'b' _batch_id, 'f' _source_file, 1L _source_row_number from values (timestamp_ntz'2024-01-01'), (timestamp_ntz'2024-02-01') t(updated_at)")
    assert [str(r.updated_at)[:10] for r in core.customer_source(staged).collect()] == ["2024-02-01"]


def test_partitioned_history_opens_no_closed_version(spark, tmp_path):
    stored = VersionHistory(spark, str(tmp_path / "history"), "customer_id")
    state, plain, spoilt = {f"C{i}": ("X", "2024-01-01") for i in range(9)}, None, {}
    for step in range(3):
        if step:
            state = {k: ("Y", f"2024-0{step + 1}-01") if i % (step + 1) == 0 else v for i, (k, v) in enumerate(state.items())}
            state.pop(f"C{step}")
            state[f"N{step}"] = ("Z", "2024-01-05")
        rows = source(spark, *[(k, c, "R1", at) for k, (c, at) in state.items()])
        plain = scd2.open_versions(rows, "customer_id") if plain is None else scd2.snapshot(plain, rows, "customer_id", f"2024-0{step + 5}-01")
        assert stored.snapshot(rows, f"2024-0{step + 5}-01") == step + 1
        # Closed files turn to rubbish once they are written; their bytes come back at the end.
        for part in stored.table.parts().where("value <> 'open'").collect():
            for file in (tmp_path / "history" / part.folder).glob("*.parquet"):
                spoilt.setdefault(file, file.read_bytes())
                file.write_bytes(b"rubbish")
    assert len({file.parent for file in spoilt}) == 2
    assert stored.snapshot(rows, "2024-09-01") is None and stored.table.current_version() == 3
    assert {r.customer_id for r in stored.current().collect()} == set(state)
    for file, content in spoilt.items():
        file.write_bytes(content)
    assert spans(stored.read()) == spans(plain) and set(stored.read().columns) == set(plain.columns)
    assert len(spans(stored.read(1))) == 9
    assert stored.snapshot(source(spark), "2024-10-01") == 4 and stored.current().count() == 0
    assert stored.snapshot(source(spark), "2024-11-01") is None
