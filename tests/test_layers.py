"""The layers of the warehouse as ``materialize_layers`` makes them."""

from conftest import SF

from tidemark.catalog import queries
from tidemark.catalog.warehouse import Warehouse
from tidemark.plans import increments


def test_the_incremental_layer_is_merged_from_two_increments(spark, monkeypatch):
    built, build = [], increments.build_increment

    def noted(*args, **more):
        built.append((args[1], args[2], args[3].count(), build(*args, **more)))
        return built[-1][-1]

    monkeypatch.setattr(increments, "build_increment", noted)
    w = Warehouse(spark, SF)

    rows = {r.kind: r.rows for r in queries.materialize_layers(w).collect()}

    (path, name, first, _), (again, _, both, _) = built
    assert name == "fct_orders" and again == path and 0 < first < both
    assert increments.fact_table(spark, path, name).current_version() == 2
    assert rows["incremental"] == w.table("fct_orders").count() == increments.stored_fact(spark, path, name).count()
