import numpy as np
import pytest

from postlake.llm import embeddings
from tests.llm.helpers import empty, rows_of, union_find

SCHEMA = "vec_id long, embedding array<float>, label int, rep string, block string, n_links string, cell int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "r", "b", "x", 1) for r in rows], SCHEMA)


def brute(rows, threshold):
    def sound(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)

    unit = {k: np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float)) for k, (i, v, label) in enumerate(rows) if sound(v) and label is not None and i is not None}
    keys = list(unit)
    pairs = [(a, b) for a in keys for b in keys if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    groups = union_find([rows[k][0] for k in keys], [(rows[a][0], rows[b][0]) for a, b in pairs])
    out = []
    for k, (i, _, _) in enumerate(rows):
        links, group = sum(k in p for p in pairs), groups.get(i, i) if k in unit else i
        out.append((i, links, group, i is not None and i == group))
    return sorted(out, key=str)


def near_groups(dim, n, noise, seed=1):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((12, dim))
    rows = []
    for k in range(n):
        v = centres[k % 12] + noise * draw.standard_normal(dim) * draw.random()
        rows.append((k * 3 + 1, (v * 10.0 ** draw.integers(-3, 3)).astype(np.float32).tolist(), int(k % 3)))
    return rows


@pytest.mark.parametrize("dim,threshold,tile", [(64, 0.98, 2048), (64, 0.98, 7), (10, 0.95, 2048), (3, 0.999, 5)])
def test_equals_brute_force(spark, dim, threshold, tile):
    rows = near_groups(dim, 240, 0.3)
    rows += [(10_000 + k, rows[k % 5][1], rows[k % 5][2]) for k in range(30)]
    expected = brute(rows, threshold)
    assert 10 < len({r[2] for r in expected}) < 260 and max(r[1] for r in expected) > 5
    found = rows_of(embeddings.near_vectors(table(spark, rows), threshold, tile), "vec_id", "n_links", "component_id", "kept")
    assert sorted(found, key=str) == expected


def test_unfit_vectors_link_with_nothing(spark):
    v = [1.0, 2.0, 3.0]
    rows = [
        (1, v, 1), (2, v, 1), (3, [2.0, 4.0, 6.0], 1), (4, v, 2), (5, v, None), (6, v, None), (7, None, 1), (8, [0.0] * 3, 1), (9, [0.0] * 3, 1), (10, [1.0, None, 3.0], 1),
        (11, [1.0, float("nan"), 3.0], 1), (12, [1.0, float("inf"), 3.0], 1), (13, [1.0, 2.0], 1), (14, [], 1), (None, v, 1), (15, [1e-40, 2e-40, 3e-40], 1), (2, v, 1),
    ]
    found = {r[0]: r[1:] for r in rows_of(embeddings.near_vectors(table(spark, rows)), "vec_id", "n_links", "component_id", "kept") if r[0] != 2}
    assert found[1] == (4, 1, True) and found[3] == (4, 1, False) and found[15][1:] == (1, False)
    assert found[None] == (0, None, False)
    for i in (4, 5, 6, 7, 8, 9, 10, 11, 12, 13, 14):
        assert found[i] == (0, i, True)


def test_empty_table(spark):
    assert rows_of(embeddings.near_vectors(empty(table(spark, near_groups(4, 5, 0.1)))), "vec_id") == []
    assert rows_of(embeddings.near_vectors(table(spark, [(1, None, 1)])), "vec_id", "n_links") == [(1, 0)]
