"""Vectors that crowd together: a hub with many neighbours that are not alike, and a cone; rounding never decides a link."""

import numpy as np
import pytest

pytest.importorskip("curveloom.llm")

from test_llm import roots  # noqa: E402

from curveloom.llm import embedding_dedup as ed  # noqa: E402


def brute(x, threshold=0.93):
    near = np.triu(x @ x.T >= threshold, 1)
    i, j = np.nonzero(near)
    return near.sum(0) + near.sum(1), roots(list(zip(i.tolist(), j.tolist())), range(len(x)))


def unit(x):
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def run(spark, x):
    rows = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    got = {r.vec_id: r for r in ed.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()}
    return np.array([got[i].n_links for i in range(len(x))]), [got[i].component_id for i in range(len(x))]


def test_hub(spark):
    rng = np.random.default_rng(1)
    hub = unit(rng.standard_normal((1, 64)))
    away = rng.standard_normal((1200, 64))
    away = unit(away - (away @ hub.T) * hub)
    x = np.concatenate((hub, 0.935 * hub + np.sqrt(1 - 0.935**2) * away, unit(rng.standard_normal((1500, 64)))))
    links, root = brute(x)
    assert links[0] > 1000 and np.median(links[1:1201]) < 10
    n, components = run(spark, x)
    assert (n <= links).all() and n.sum() >= 0.97 * links.sum()
    assert np.mean([components[i] == root[i] for i in range(len(x))]) > 0.97


def test_cone(spark):
    rng = np.random.default_rng(2)
    middle = unit(rng.standard_normal((1, 48)))
    x = unit(middle + 0.045 * rng.standard_normal((1500, 48)))
    links, root = brute(x)
    assert 5 < np.median(links) < 1400
    n, components = run(spark, x)
    assert (n <= links).all() and n.sum() >= 0.99 * links.sum() and np.mean([components[i] == root[i] for i in range(len(x))]) > 0.99


def test_bytes_bound_the_error():
    rng = np.random.default_rng(3)
    for d in (1, 2, 16, 300):
        x = unit(rng.standard_normal((200, d)) * rng.uniform(0.001, 10, (200, d)))
        y, slack = ed.unpacked(ed.packed(x))
        assert (np.abs(x @ x.T - y @ y.T) <= slack[:, None] + slack).all()
