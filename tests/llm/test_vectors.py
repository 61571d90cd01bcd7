import math

import numpy as np
import pytest

from coursepulse.llm import vectors
from coursepulse.llm.links import components


def brute_force(rows, threshold):
    sound = [(i, np.array(v, float)) for i, v in rows
             if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    links = {i: set() for i, _ in rows}
    for n, (i, a) in enumerate(sound):
        for j, b in sound[n + 1:]:
            if len(a) == len(b) and (a @ b) / math.sqrt((a @ a) * (b @ b)) >= threshold:
                links[i].add(j)
                links[j].add(i)
    out = {}
    for i in links:
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        out[i] = (len(links[i]), min(seen))
    return out


def frame(spark, rows, kind="double"):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], f"vec_id long, embedding array<{kind}>, label int, id string")


@pytest.mark.parametrize("kind, tile", [("double", 2048), ("float", 7)])
def test_links_equal_brute_force(spark, kind, tile):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    rows = []
    for k in range(120):
        v = centres[k % 6] * rng.uniform(0.1, 9) + rng.normal(size=16) * rng.choice([0, 0.05, 0.3, 1])
        rows.append((k * 11 % 1009, [float(x) for x in v.astype(np.float32)]))
    rows += [(2000 + k, rows[0][1]) for k in range(40)]  # a hot vector
    rows += [(3000, None), (3001, []), (3002, [0.0] * 16), (3003, [float("nan")] * 16), (3004, [float("inf")] + [1.0] * 15),
             (3005, [None] + [1.0] * 15), (3006, [-x for x in rows[0][1]]), (3007, [x * 2 for x in rows[1][1]])]
    got = {r.id: (r.n_links, r.component_id) for r in vectors.links(frame(spark, rows, kind), tile=tile).collect()}
    assert got == brute_force(rows, 0.95)


def test_cut_cells_and_boxes(spark):
    """Vectors with strong leading axes: full cells are cut along further axes, most pairs of tiles are dropped, no link is lost."""
    rng = np.random.default_rng(11)
    strength = 2.0 ** -np.arange(20)
    centres = rng.normal(size=(30, 20)) * strength
    rows = [(k, [float(x) for x in centres[k % 30] + rng.normal(size=20) * strength * (0.02 if k % 3 else 0.8)]) for k in range(500)]
    got = {r.id: (r.n_links, r.component_id) for r in vectors.links(frame(spark, rows), tile=8).collect()}
    assert got == brute_force(rows, 0.95)

    classes = frame(spark, rows).select(vectors.F.col("vec_id").alias("id"), vectors.F.col("embedding").alias("v"), vectors.F.lit(1).cast("long").alias("weight"))
    basis = vectors._axes(classes, 20)
    unit = vectors._unit(np.array([v for _, v in rows]))
    assert np.allclose(abs(basis.T @ (unit.T @ unit) @ basis - np.diag(np.diag(basis.T @ (unit.T @ unit) @ basis))), 0, atol=1e-9)
    width = math.sqrt(0.1) + 1e-9
    tiles = vectors._tiles(classes, basis, width, 2, 8, np.float64).cache()
    cells = {tuple(r.cell) for r in tiles.collect()}
    assert {len(c) for c in cells} > {2} and not any(c != d and d[:len(c)] == c for c in cells for d in cells)
    assert sum(len(r.ids) // 8 for r in tiles.collect()) == 500
    every = tiles.count()
    assert vectors._tile_pairs(tiles, width, 2).count() < every * (every + 1) / 2 * 0.7
    tiles.unpersist()


def test_moments_of_many_rows_are_added_up(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SUM_BYTES", 100)  # a row or two of the moments in each row
    rng = np.random.default_rng(2)
    v = rng.normal(size=(50, 7)) * np.arange(1, 8)
    classes = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, v array<double>").repartition(9)
    basis, unit = vectors._axes(classes, 7), vectors._unit(v)
    strength = np.diag(basis.T @ (unit.T @ unit) @ basis)
    assert np.allclose(strength, np.linalg.eigvalsh(unit.T @ unit)[::-1])


def test_other_lengths_ids_and_empty_tables(spark):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [1.0]), (4, [1.0]), (None, [1.0, 0.0]), (2, [1.0, 0.01]), (5, [2.0, 0.0])]
    got = {r.id: (r.n_links, r.component_id) for r in vectors.links(frame(spark, rows)).collect()}
    assert got == {1: (4, 1), 2: (4, 1), 5: (4, 1), None: (4, 1), 3: (1, 3), 4: (1, 3)}
    assert vectors.links(frame(spark, rows)).count() == 7
    alone = {(r.id, r.n_links, r.component_id) for r in vectors.links(frame(spark, [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (7, [3.0])])).collect()}
    assert alone == {(None, 1, None), (7, 0, 7)}
    assert vectors.links(frame(spark, [])).count() == 0
    assert vectors.links(frame(spark, [(1, None)])).collect()[0][:] == (1, 0, 1)


def test_components_of_a_chain_a_star_and_a_ring(spark):
    chain = [(i, i + 1) for i in range(1, 60)]
    star = [(500, 1000 + i) for i in range(200)]
    ring = [(300 + i, 300 + (i + 1) % 7) for i in range(7)]
    edges = spark.createDataFrame(chain + star + ring + [(9, 9)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert {got[i] for i in range(1, 61)} == {1}
    assert {got[1000 + i] for i in range(200)} == {500} and {got[300 + i] for i in range(7)} == {300}
    assert components(edges.limit(0)).count() == 0
