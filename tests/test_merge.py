from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.operators.dedup import latest_by_key
from tidemark.plans.publish import publish_marts
from tidemark.sources.commits import CommitLog, Conflict
from tidemark.sources.tables import ManifestTable


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "id string, month string, v long")


def test_upsert_replaces_inserts_and_never_deletes(spark, rows):
    target, source = frame(spark, ("a", "1", 1), ("b", "1", 2)), frame(spark, ("b", "2", 20), ("c", "1", 30))
    assert rows(merge.upsert(target, source, ["id"])) == [("a", "1", 1), ("b", "2", 20), ("c", "1", 30)]
    wider = merge.upsert(target, source.withColumn("extra", F.lit("x")), ["id"])
    assert {(r.id, r.extra) for r in wider.collect()} == {("a", None), ("b", "x"), ("c", "x")}


def table(spark, tmp_path, partition="month"):
    return ManifestTable(spark, str(tmp_path / "t"), keys=("id",), partition_by=(partition,))


def folders(t):
    return {r.value: r.folder for r in t.parts().collect()}


def test_merge_rewrites_touched_partitions_only(spark, rows, tmp_path):
    t = table(spark, tmp_path)

    def apply(*changes):
        return t.merge(frame(spark, *changes))

    assert apply(("a", "m1", 1), ("b", "m2", 2), ("c", "m3", 3)) == 3
    before = folders(t)
    assert apply(("b", "m2", 20), ("d", "m1", 4)) == 2
    assert folders(t)["m3"] == before["m3"] and folders(t)["m1"] != before["m1"]
    # b leaves m2, which nothing else is in
    assert apply(("b", "m1", 21)) == 2 and set(folders(t)) == {"m1", "m3"}
    assert rows(t.read().select("id", "month", "v")) == [("a", "m1", 1), ("b", "m1", 21), ("c", "m3", 3), ("d", "m1", 4)]
    assert apply() == 0 and t.current_version() == 3


def test_merge_opens_only_partitions_that_may_hold_its_keys(spark, tmp_path):
    """100 partitions, 10 keys: all data files but those of the partitions that hold them are replaced by rubbish."""
    t = table(spark, tmp_path)
    t.merge(spark.range(20_000).selectExpr("cast(id as string) id", "concat('m', id % 100) month", "id v"))
    keys = [str(k * 100 + k % 3) for k in range(10)]
    source = spark.createDataFrame([(k, f"m{int(k) % 100}" if k != keys[0] else "m50", -1) for k in keys], "id string, month string, v long")
    chosen = {r.folder for r in t.may_hold(source, t.parts()).collect()}
    hit = {f"m{int(k) % 100}" for k in keys} | {"m50"}
    assert {folders(t)[f"m{int(k) % 100}"] for k in keys} == chosen
    for value, folder in folders(t).items():
        if value not in hit:
            for file in (tmp_path / "t" / folder).glob("*.parquet"):
                file.write_bytes(b"rubbish")
    assert t.merge(source) == len(hit) == 4
    got = t.read(where=F.col("value").isin(*hit))
    assert {(r.id, r.month) for r in got.where("v = -1").collect()} == {(r.id, r.month) for r in source.collect()}
    assert got.count() == 801 - 1 and t.read(version=1, where="value = 'm0'").where("v < 0").count() == 0


def test_index_misses_no_key(spark, tmp_path):
    t = table(spark, tmp_path)
    t.merge(spark.range(30_000).selectExpr("cast(id as string) id", "concat('m', floor(sqrt(id))) month", "id v"))
    every = t.read().select("id", "month").join(t.parts().select(F.col("value").alias("month"), "folder"), "month")
    for k in range(0, 30_000, 3001):
        chosen = {r.folder for r in t.may_hold(spark.createDataFrame([(str(k),)], "id string"), t.parts()).collect()}
        assert every.where(F.col("id") == str(k)).first().folder in chosen and len(chosen) <= 4  # of 174
    assert t.may_hold(every, t.parts()).distinct().count() == 174


def test_a_broken_merge_leaves_the_old_version(spark, rows, tmp_path, monkeypatch):
    t = table(spark, tmp_path)
    t.merge(frame(spark, ("a", "m1", 1), ("b", "m2", 2)))
    monkeypatch.setattr(CommitLog, "create", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        t.merge(frame(spark, ("a", "m2", 10), ("b", "m1", 20)))
    assert rows(t.read()) == [("a", "m1", 1), ("b", "m2", 2)] and t.current_version() == 1
    monkeypatch.undo()
    assert t.merge(frame(spark, ("a", "m2", 10), ("b", "m1", 20))) == 2
    assert rows(t.read()) == [("a", "m2", 10), ("b", "m1", 20)] and rows(t.read(version=1)) == [("a", "m1", 1), ("b", "m2", 2)]


def test_writers_side_by_side_lose_no_row(spark, rows, tmp_path):
    t = table(spark, tmp_path)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: t.merge(frame(spark, (f"k{k}", "shared", k), (f"own{k}", f"m{k}", k))), range(8)))
    assert rows(t.read().select("id", "v")) == sorted([(f"k{k}", k) for k in range(8)] + [(f"own{k}", k) for k in range(8)]) and t.current_version() == 8


def test_unchanged_partitions_are_shared(spark, rows, tmp_path):
    t = table(spark, tmp_path)
    first = frame(spark, ("a", "m1", 1), ("b", "m2", 2), ("c", None, 3))
    for n in (1, 2):
        t.publish(t.stage(first))
        assert t.current_version() == n and len(list((tmp_path / "t" / "data").iterdir())) == 1
    before = folders(t)
    t.publish(t.stage(frame(spark, ("b", "m2", 2), ("c", None, 4), ("d", "m4", 5))))
    after = folders(t)
    assert after["m2"] == before["m2"] and after[None] != before[None] and set(after) == {"m2", None, "m4"}
    assert rows(t.read()) == [("b", "m2", 2), ("c", None, 4), ("d", "m4", 5)]
    stale = t.stage(first)
    t.publish(t.stage(first))
    with pytest.raises(Conflict):
        t.publish(stale)
    assert t.expire(keep=1) == 4 and rows(t.read()) == rows(first) and t.log.numbers() == [4]


def test_filter_before_dedup_equals_filter_after(spark, rows):
    raw = spark.range(400).selectExpr(
        "cast(id % 60 as string) k", "cast(timestamp_ntz'2026-01-01' + make_dt_interval(cast(id * 7919 % 40 as int)) as string) updated_at",
        "'b' _batch_id", "'f' _source_file", "id _source_row_number",
    )
    cut = merge.lookback_cut(raw.select(F.col("updated_at").cast("timestamp_ntz").alias("updated_at")))
    before = latest_by_key(merge.increment_before_dedup(raw, "updated_at", cut), ["k"], "updated_at")
    after = merge.increment_before_dedup(latest_by_key(raw, ["k"], "updated_at"), "updated_at", cut)
    assert 0 < before.count() < 60 and rows(before) == rows(after)


def test_text_cut_reaches_the_scan(spark, rows, tmp_path):
    times = [(str(i), f"2026-01-{i:02d}T00:00:00Z") for i in range(1, 29)]
    spark.createDataFrame(times, "k string, updated_at string").write.parquet(str(tmp_path / "raw"))
    raw = spark.read.parquet(str(tmp_path / "raw"))
    cut = merge.lookback_cut(raw.select(F.col("updated_at").cast("timestamp_ntz").alias("updated_at")))
    as_text = merge.increment_before_dedup(raw, "updated_at", cut, "%Y-%m-%dT%H:%M:%SZ")
    assert "GreaterThan(updated_at,2026-01-21T00:00:00Z)" in as_text._jdf.queryExecution().toString()
    assert rows(as_text) == rows(merge.increment_before_dedup(raw, "updated_at", cut)) and as_text.count() == 7


def test_empty_target_has_no_cut(spark):
    empty = spark.sql("select timestamp_ntz'2026-01-01' updated_at").where("false")
    cut = merge.lookback_cut(empty)
    assert cut is None
    assert spark.range(3).where(merge.since_cut("id", cut)).count() == 3


def test_publish_gate(spark, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "pub"))
    with pytest.raises(LookupError):
        table.read()

    def audit(df):
        return df.agg(F.count_if(F.col("v") < 0).alias("violations")).withColumn("check_name", F.lit("negative"))

    assert table.publish_if(frame(spark, ("a", "1", 1)), audit) == (1, 0)
    assert table.publish_if(frame(spark, ("a", "1", -1)), audit) == (2, 1)
    assert [r.v for r in table.read().collect()] == [1]
    by_month = ManifestTable(spark, str(tmp_path / "pub"), partition_by=("month",))
    assert by_month.publish_if(frame(spark, ("a", "1", 5), ("b", "2", 6)), audit) == (2, 0)
    assert sorted(r.v for r in table.read().collect()) == [5, 6]


@pytest.mark.parametrize("kind, before, after", [
    ("string", "a/b", "c"), ("string", "a=b c%:", "x"), ("string", None, "x"), ("string", "x", None), ("string", "", "x"), ("string", "x", ""),
    ("timestamp_ntz", "2024-01-01 10:00:00", "2024-01-02 00:00:00.5"), ("date", "2024-01-01", None), ("boolean", "true", "false"), ("int", "7", "-8"),
    ("decimal(10,2)", "1.50", "2.00"),
])
def test_a_row_that_moves_leaves_no_old_version(spark, tmp_path, kind, before, after):
    t = table(spark, tmp_path, "p")

    def apply(*changes):
        t.merge(spark.createDataFrame(list(changes), "id string, p string, v int").withColumn("p", F.col("p").cast(kind)))

    apply(("k", before, 1), ("other", "1" if kind in ("int", "decimal(10,2)") else "2030-05-05" if kind != "boolean" else "true", 1))
    apply(("k", after, 2))
    got = t.read().where("id = 'k'").select(F.col("p").cast("string"), "v").collect()
    want = spark.createDataFrame([(after or None,)], "p string").select(F.col("p").cast(kind).cast("string")).first()[0]
    assert [tuple(r) for r in got] == [(want, 2)] and t.read().count() == 2


def test_columns_of_one_side_are_kept(spark, tmp_path):
    t = table(spark, tmp_path, "p")

    def apply(rows, schema):
        t.merge(spark.createDataFrame(rows, schema))

    apply([("a", "1", 1, "x"), ("b", "1", 2, "y"), ("c", "2", 3, "z")], "id string, p string, v int, extra string")
    apply([("a", "1", 10, 0.5)], "id string, p string, v int, late double")
    got = t.read().collect()
    assert {(r.id, r.v, r.extra, r.late) for r in got} == {("a", 10, None, 0.5), ("b", 2, "y", None), ("c", 3, "z", None)}


def test_an_older_row_does_not_replace_a_newer_one(spark, tmp_path):
    t = table(spark, tmp_path)
    for month, v in [("m1", 5), ("m1", 1), ("m2", 3), ("m2", 6)]:
        t.merge(frame(spark, ("a", month, v)), order_by="v")
    assert [(r.month, r.v) for r in t.read().collect()] == [("m2", 6)]


def test_rows_that_cannot_move_are_sought_in_their_partition(spark, tmp_path, rows):
    t = table(spark, tmp_path)
    t.merge(frame(spark, ("a", "m1", 1), ("b", "m2", 2)))
    assert t.merge(frame(spark, ("a", "m1", 10)), moves=False) == 1
    assert rows(t.read()) == [("a", "m1", 10), ("b", "m2", 2)]


def test_marts_are_published_together_or_not_at_all(spark, tmp_path):
    state = {"rows": 1, "action": "none"}

    def results():
        return spark.createDataFrame([("grain:a", state["action"]), ("late", "warn")], "check_name string, action string")

    def publish():
        return publish_marts(spark, str(tmp_path), lambda mart: spark.range(state["rows"]), ["a", "b"], results)

    def counts():
        return [ManifestTable(spark, str(tmp_path / mart)).read().count() for mart in ("a", "b")]

    assert publish() == [] and counts() == [1, 1]
    state.update(rows=5, action="fail")
    assert publish() == ["grain:a"] and counts() == [1, 1]
    state.update(action="none")
    assert publish() == [] and counts() == [5, 5]
