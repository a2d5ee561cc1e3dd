"""Sketches of batches against exact shares."""

import random

from pyspark.sql import functions as F

from tidemark.plans import drift


def batches(spark, shifted=()):
    rng = random.Random(11)
    rows = []
    for b in range(6):
        for _ in range(2000):
            value = int(rng.lognormvariate(5, 1)) * (3 if b in shifted else 1)
            kind = rng.choices(["x", "y", None], [1, 9, 1] if b in shifted else [8, 1, 1])[0]
            rows.append((f"b{b}", None if rng.random() < 0.1 else value, b if b < 2 else 7, None, kind))
    return spark.createDataFrame(rows, "batch string, amount long, step int, empty long, kind string"), rows


def test_quantiles_are_within_the_stated_error(spark):
    df, rows = batches(spark)
    for r in drift.quantiles(drift.batch_sketches(df, "batch", ["amount"])).collect():
        values = [v[1] for v in rows if v[0] == r.batch and v[1] is not None]
        assert r.n == len(values)
        below, up_to = (sum(v < r.value for v in values) / r.n, sum(v <= r.value for v in values) / r.n)
        assert below - drift.SHARE_ERROR <= r.probability <= up_to + drift.SHARE_ERROR


def test_a_shifted_batch_is_reported_and_others_are_not(spark, tmp_path):
    df, rows = batches(spark, shifted=(4,))
    # Kept batch by batch, read together.
    for b in sorted({r[0] for r in rows}):
        drift.batch_sketches(df.where(F.col("batch") == b), "batch", ["amount", "step", "empty"]).write.mode("append").parquet(str(tmp_path / "sketches"))
        drift.batch_counts(df.where(F.col("batch") == b), "batch", ["kind"]).write.mode("append").parquet(str(tmp_path / "counts"))
    numeric = drift.numeric_drift(spark.read.parquet(str(tmp_path / "sketches"))).collect()
    found = {(r.batch, r.column): r for r in numeric}
    assert {k for k, r in found.items() if r.drifted} == {("b4", "amount"), *((f"b{b}", "step") for b in range(1, 6))}
    error = 1 / drift.STEPS + 2 * drift.SHARE_ERROR
    assert all(abs(found[f"b{b}", "step"].distance - d) <= error for b, d in ((1, 1), (2, 1), (3, 2 / 3), (4, 0.5), (5, 0.4)))
    assert set(found) == {(f"b{b}", c) for b in range(1, 6) for c in ("amount", "step")}
    then = sorted(v[1] for v in rows if v[0] < "b4" and v[1] is not None)
    now = sorted(v[1] for v in rows if v[0] == "b4" and v[1] is not None)
    exact = max(abs(sum(v <= x for v in now) / len(now) - sum(v <= x for v in then) / len(then)) for x in sorted(set(now + then))[::3])
    got = found["b4", "amount"]
    assert abs(got.distance - exact) < 0.05 and (got.n, got.n_before) == (len(now), len(then))

    kinds = {r.batch: r for r in drift.category_drift(spark.read.parquet(str(tmp_path / "counts"))).collect()}
    assert set(kinds) == {f"b{b}" for b in range(1, 6)} and {b for b, r in kinds.items() if r.drifted} == {"b4"}
    share = {b: sum(r[4] == "x" for r in rows if r[0] in b) / (2000 * len(b)) for b in (("b4",), ("b0", "b1", "b2", "b3"))}
    assert abs(kinds["b4"].distance - max(abs(share[("b4",)] - share[("b0", "b1", "b2", "b3")]), 0)) < 0.05


def test_only_the_batches_before_are_compared(spark):
    df, _ = batches(spark, shifted=(4,))
    near = drift.numeric_drift(drift.batch_sketches(df, "batch", ["amount"]), before=1).collect()
    assert {r.batch for r in near if r.drifted} == {"b4", "b5"} and all(r.n_before < 2001 for r in near)
    counts = drift.category_drift(drift.batch_counts(df, "batch", ["kind"]), before=1).collect()
    assert {r.batch for r in counts if r.drifted} == {"b4", "b5"} and all(r.n_before == 2000 for r in counts)


def test_no_rows_no_drift(spark):
    df, _ = batches(spark)
    assert drift.numeric_drift(drift.batch_sketches(df.limit(0), "batch", ["amount"])).count() == 0
    assert drift.category_drift(drift.batch_counts(df.limit(0), "batch", ["kind"])).count() == 0
