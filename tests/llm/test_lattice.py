import itertools

import numpy as np

from obsmill.llm import lattice
from obsmill.llm.lattice import NEIGHBOURS, near_vectors, nearest_e8


def test_decoding_finds_the_nearest_point():
    x = np.random.default_rng(1).uniform(-3, 3, (400, 8))
    p = nearest_e8(x)
    assert np.all((2 * p == np.rint(2 * p)).all(axis=1)) and np.all(p.sum(axis=1) % 2 == 0)
    own = ((x - p) ** 2).sum(axis=1)
    for v in NEIGHBOURS:
        assert np.all(((x - p - v) ** 2).sum(axis=1) >= own - 1e-9)
    assert len(NEIGHBOURS) == 240 and np.allclose((NEIGHBOURS**2).sum(axis=1), 2)


def test_links_of_planted_groups_are_exact_and_threshold_recall_is_high(spark):
    draw = np.random.default_rng(4)
    rows, name = [], 0
    for k in range(60):
        centre = draw.standard_normal(24)
        for _ in range(int(draw.integers(1, 9))):
            rows.append((name, (centre + draw.normal(0, 0.08 + 0.1 * (k % 2), 24)).tolist(), k % 3))
            name += 1
    rows += [(name, rows[0][1], rows[0][2]), (name + 1, rows[0][1], rows[0][2]), (name + 2, rows[0][1], None)]
    rows += [(name + 3, None, 1), (name + 4, [0.0] * 24, 1), (name + 5, [None] + [1.0] * 23, 1), (name + 6, [float("nan")] * 24, 1), (name + 7, [], 1), (name + 8, [1.0, 2.0], 1), (name + 9, [2.0, 4.0], 1)]
    embeddings = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    valid = [r for r in rows if r[1] and r[2] is not None and None not in r[1] and np.isfinite(r[1]).all() and any(r[1])]
    want, links = {r[0]: 0 for r in rows}, []
    for a, b in itertools.combinations(valid, 2):
        if a[2] == b[2] and len(a[1]) == len(b[1]):
            x, y = np.array(a[1]), np.array(b[1])
            if x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93:
                want[a[0]] += 1
                want[b[0]] += 1
                links.append((a[0], b[0]))
    for part in (1500, 3):
        found = {r.vec_id: r for r in near_vectors(embeddings, part=part).collect()}
        over = [(k, n, found[k].n_links, part) for k, n in want.items() if found[k].n_links > n]
        assert len(found) == len(rows) and not over
        assert sum(r.n_links for r in found.values()) >= 0.95 * sum(want.values())
        assert all(found[a].component_id == found[b].component_id for a, b in links if found[a].n_links == want[a] and found[b].n_links == want[b])
        assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())
        assert found[name].component_id == 0 and found[name + 9].component_id == name + 8 and found[name + 2].n_links == 0
    assert near_vectors(embeddings.limit(0)).count() == 0


def test_a_hot_cell_gets_buckets_for_its_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BUCKET", 1_000)
    counts = spark.createDataFrame([(600,), (2,), (40,)], "_all long")
    # 600 vectors in parts of 30 are 20 rows each.
    assert lattice._buckets(counts, 30) == -(-(600 * 20 + 2 + 40 * 2) // 1_000)
    assert lattice._buckets(counts.limit(0), 30) == 1
