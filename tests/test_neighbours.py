"""Projected neighbours: recall against all pairs, exact distances."""

import numpy as np
import pytest

from rarecast.operators import neighbours as NN


def recall_of(spark, x, k=5, **more):
    df = spark.createDataFrame([(f"r{i:05d}", v.tolist()) for i, v in enumerate(x)], "id string, v array<double>")
    got = NN.projected_neighbours(df, "id", "v", k, **more).collect()
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(2)) if len(x) <= 2500 else None
    np.fill_diagonal(d, np.inf)
    order = np.argsort(d, axis=1, kind="stable")[:, :k]
    want = {f"r{i:05d}": {f"r{j:05d}" for j in row} for i, row in enumerate(order)}
    by = {}
    for r in got:
        by.setdefault(r.id, []).append(r)
        assert r.dist == pytest.approx(d[int(r.id[1:]), int(r.nb_id[1:])], abs=1e-9) and r.id != r.nb_id
    assert all(sorted(x.nb_rank for x in v) == list(range(1, k + 1)) for v in by.values()) and len(by) == len(x)
    return sum(len({x.nb_id for x in v} & want[i]) for i, v in by.items()) / (k * len(x))


def test_recall_on_the_embeddings(spark):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").limit(2000).collect()
    assert recall_of(spark, np.array([r["embedding"] for r in rows], float)) >= 0.9


def test_edges(spark):
    schema = "id string, v array<double>"
    assert NN.projected_neighbours(spark.createDataFrame([], schema), "id", "v").collect() == []
    assert NN.projected_neighbours(spark.createDataFrame([("a", [1.0])], schema), "id", "v").collect() == []
    same = spark.createDataFrame([(f"k{i}", [1.0, 2.0]) for i in range(300)], schema)
    rows = NN.projected_neighbours(same, "id", "v", k=3, leaf=32, trees=2).collect()
    assert len(rows) == 900 and {r.dist for r in rows} == {0.0}
