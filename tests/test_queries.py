"""Every fleet query against its SQL, on the smallest tables."""

import pytest

from conftest import DATA, rows
from wayloom.operators import pings, serving, windows
from wayloom.plans import registry
from wayloom.sources import fixture

SQL = registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query(spark, duck, name):
    got = registry.queries()[name](spark, str(DATA)).toPandas()
    if name not in SQL:
        assert len(got)
        return
    want = duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_imports_and_lists(spark):
    import __spark_entry__ as e

    assert set(SQL) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).columns


def test_principal_components(spark):
    got = [r["ratio"] for r in registry.queries()["pca_explained_variance"](spark, str(DATA)).collect()]
    assert abs(sum(got) - 1) < 1e-9 and got == sorted(got, reverse=True)


def test_principal_components_against_numpy(spark):
    """Scores and loadings from the features themselves, by another decomposition."""
    import numpy as np

    names = list(windows.FEATURE_COLUMNS)
    table = registry.queries()["vehicle_features"](spark, str(DATA)).toPandas().sort_values(["vehicle", "window_start_ms"])
    x = table[names].fillna(0).to_numpy(float)
    z = (x - x.mean(axis=0)) / np.where(x.std(axis=0) > 0, x.std(axis=0), 1)
    _, values, axes = np.linalg.svd(z, full_matrices=False)
    ratio = registry.queries()["pca_explained_variance"](spark, str(DATA)).toPandas().sort_values("component")["ratio"]
    assert np.allclose(ratio, values**2 / (values**2).sum(), atol=1e-5)
    got = registry.queries()["pca_loadings"](spark, str(DATA)).toPandas().set_index("feature").loc[names].to_numpy()
    signs = np.sign((got * axes[:4].T).sum(axis=0))
    assert np.allclose(got, axes[:4].T * signs, atol=1e-3)
    scores = registry.queries()["pca_scores"](spark, str(DATA)).toPandas().sort_values(["vehicle", "window_start_ms"])
    assert np.allclose(scores[[f"pc{i}" for i in range(1, 5)]], z @ axes[:4].T * signs, atol=1e-2)


def test_update_messages_say_what_the_pings_say(spark):
    import json

    fields = ("driver", "x", "y", "speed", "heading", "ignition", "aircon", "working", "doorUp", "doorDown", "routeNo", "routeId")
    want = {}
    for r in pings.clean(fixture.pings(spark, str(DATA)), fixture.routes(spark, str(DATA))).collect():
        want[r["event_id"], r["copy"]] = {"vehicle": r["vehicle"], "datetime": r["datetime"]} | {f: r[f] for f in fields if r[f] is not None}
    got = {(r["event_id"], r["copy"]): json.loads(r["message"]) for r in registry.queries()["bus_update_messages"](spark, str(DATA)).collect()}
    assert got == want


def test_hashes_hold_the_numbers(spark):
    state = serving.current_state(pings.clean(fixture.pings(spark, str(DATA)), fixture.routes(spark, str(DATA))))
    got = {r["vehicle"]: r for r in serving.hashes(state).collect()}
    for r in state.collect():
        h = got[r["vehicle"]]
        assert [None if h[k] is None else float(h[k]) for k in ("lon", "lat", "speed", "heading")] == [r[k] for k in ("x", "y", "speed", "heading")]
