"""Steps that several parts of a query read are done once; a training pass sends the driver one row."""

import numpy as np
import pytest

from traitlab.operators import exact
from traitlab.operators import features as feat
from traitlab.plans import queries as q

SF001 = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["union_known_predicted", "install_stats_repeated"])
def test_input_is_built_once(spark, name):
    files = q.REGISTRY[name](spark, SF001).inputFiles()
    assert files and not any("lineitem" in f or "orders" in f for f in files)


@pytest.mark.parametrize("name", ["model_saved_and_loaded", "result_table"])
def test_features_are_parsed_once(spark, name, monkeypatch):
    calls, plain = [], feat.parse_rows
    monkeypatch.setattr(feat, "parse_rows", lambda *a, **k: calls.append(1) or plain(*a, **k))
    assert q.REGISTRY[name](spark, SF001).count() > 0
    assert len(calls) == 1


def test_a_pass_sends_one_row_whatever_its_tasks(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [([int(k) for k in np.sort(rng.choice(50, 6, replace=False))], [1.0] * 6, float(i % 2)) for i in range(400)]
    df = spark.createDataFrame(rows, "indices array<int>, values array<double>, label double").repartition(12)
    target = exact.Target("t", 2, "label")
    expected = exact.fit(df, [target], 60, max_iter=5).values
    sizes, plain = [], exact._added

    def added(cells, sums, size):
        cells, sums = list(cells), list(sums)
        sizes.append(len(sums))
        return plain(cells, sums, size)

    monkeypatch.setattr(exact, "_added", added)
    for per_task in (1, 600):   # many tasks, few tasks
        monkeypatch.setattr(exact, "CELLS_PER_TASK", per_task)
        assert (exact.fit(df, [target], 60, max_iter=5, one_task_cells=0).values == expected).all()
    assert len(sizes) == 12 and set(sizes) == {1}


def test_sums_are_added_in_either_form():
    dense, thin = np.arange(12.0).reshape(4, 3), np.zeros((4, 3))
    thin[1, 2] = -7
    (a, b), (c, d) = exact._cells(dense), exact._cells(thin)
    assert a is None and c is not None and len(d) == 8
    assert (exact._added([a, c, c], [b, d, d], 12) == (dense + 2 * thin).ravel()).all()
