"""What increments cost the driver."""

import threading

import pytest
from test_refresh import Shop

from tidemark.plans import refresh
from tidemark.session import light_driver
from tidemark.sources.tables import ManifestTable

DESCRIBED = "spark.sql.maxPlanStringLength"


@pytest.fixture()
def jobs(monkeypatch, spark):
    """For every table written, how many others were being written and how long plans were described."""
    seen, under_way, write = [], [], ManifestTable._write

    def counted(table, rows):
        under_way.append(table.root)
        seen.append((len(under_way), spark.conf.get(DESCRIBED, None), threading.current_thread().name))
        try:
            return write(table, rows)
        finally:
            under_way.remove(table.root)

    monkeypatch.setattr(ManifestTable, "_write", counted)
    return seen


def test_a_refresh_writes_one_table_at_a_time_with_plans_described_in_short(spark, tmp_path, jobs):
    shop = Shop(spark, str(tmp_path))
    shop.merge()
    jobs.clear()

    refresh.Marts(spark, f"{shop.folder}/marts", f"{shop.folder}/facts", shop.dimension).refresh()

    assert len(jobs) >= 7 and {n for n, *_ in jobs} == {1} and len({thread for *_, thread in jobs}) == 1
    assert jobs[0][1] == "4000" and spark.conf.get(DESCRIBED, None) is None


def test_a_caller_s_length_of_descriptions_is_left_alone(spark):
    spark.conf.set(DESCRIBED, "77777")
    try:
        with light_driver(spark) as let_go:
            let_go()
            assert spark.conf.get(DESCRIBED) == "77777"
        assert spark.conf.get(DESCRIBED) == "77777"
    finally:
        spark.conf.unset(DESCRIBED)
