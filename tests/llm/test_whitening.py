import math
import random

import numpy as np
import pytest

from tableflow.llm import whitening
from tableflow.llm.whitening import OFFSET, SCALE, Moments, deviations, op12_whitening, whiten

COLUMNS = "vec_id long, embedding array<float>, label int"


def on_grid(vector):
    return [math.floor(SCALE * float(np.float32(c))) + OFFSET for c in vector]


def brute_force(rows, components=16, by_count=False):
    """{id: [(n, deviation, whitened, explained)]} up to the sign of each component."""
    good = [(i, on_grid(v)) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = [x for _, x in good] if by_count else sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    centred = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    out = {}
    for name, x in good:
        gaps = [n * c - s for c, s in zip(x, sums)]
        white = np.array(gaps, float) / n @ axes[:, ::-1][:, :components] / np.sqrt(values[::-1][:components])
        out.setdefault(name, []).append((n, sum(g * g for g in gaps), white, values[::-1][:components] / values.sum()))
    return out


@pytest.fixture(scope="module")
def vectors():
    rng = random.Random(4)
    rows = [(k, [rng.gauss(0, 1 + j / 4) for j in range(20)]) for k in range(300)]
    hot = rows[0][1]
    rows += [(1000 + k, hot) for k in range(400)]  # more than half of all rows
    rows += [(2000 + k, [c + 1e-9 for c in rows[k][1]]) for k in range(50)]  # equal on the grid, nearly always
    return rows + [(7, rows[7][1]), (None, rows[8][1])]


ODD = [(1, None), (2, [None] * 20), (3, [float("nan")] * 20), (4, [float("inf")] + [0.0] * 19), (5, []), (6, [3e38] * 20)]


@pytest.mark.parametrize("by_count", [False, True])
def test_whitened_as_by_brute_force(spark, vectors, by_count):
    rows = [(*row, 1) for row in vectors + ODD + [(9, [1.0, 2.0])]]
    frame = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 as id", "2 as x", "3 as key", "4 as weight").repartition(40)
    got = whiten(frame, by_count=by_count).collect()
    want = brute_force([row for row in vectors], by_count=by_count)
    assert sorted(row["id"] or -1 for row in got) == sorted(name or -1 for name, own in want.items() for _ in own)
    signs = None
    for row in sorted(got, key=lambda row: row["id"] or -1):
        n, deviation, white, explained = min(want[row["id"]], key=lambda own: abs(own[1] - row["deviation"]))
        assert (row["n"], row["deviation"]) == (n, deviation)
        white_ = np.array(row["whitened"])
        signs = np.sign(white_ * white) if signs is None else signs
        assert np.allclose(white_ * signs, white, atol=1e-8)
        assert np.allclose(row["explained"], explained, rtol=1e-9) and row["identity_error"] < 1e-10


def test_query_has_a_row_for_each_component(spark, vectors, tmp_path):
    rows = [(*row, 1) for row in vectors]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = op12_whitening(spark, str(tmp_path))
    assert got.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert got.count() == 16 * len(rows) and got.where("component between 1 and 16").count() == 16 * len(rows)


@pytest.mark.parametrize("rows", [[], ODD, [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, rows):
    assert whiten(spark.createDataFrame([(*row, 1) for row in rows], COLUMNS)).collect() == []


def test_fewer_directions_than_dimensions(spark):
    rng = random.Random(2)
    rows = [(k, [a := rng.gauss(0, 9), b := rng.gauss(0, 9), a, b, 5.0], 0) for k in range(60)]
    got = whiten(spark.createDataFrame(rows, COLUMNS)).collect()
    assert {len(row["whitened"]) for row in got} == {2} and got[0]["identity_error"] < 1e-9


def test_moments_merge_to_those_of_all_rows():
    rng = np.random.default_rng(1)
    rows, weights = rng.normal(1e6, 1, (500, 6)), rng.integers(1, 9, 500).astype(float)
    parts = [Moments.of(rows[k::7], weights[k::7]) for k in range(7)]
    total = parts[0]
    for part in parts[1:]:
        total = total.add(part)
    want = np.cov(rows.T, aweights=weights, ddof=0)
    assert np.allclose(total.scatter / total.weight, want, rtol=1e-8, atol=1e-9)


def test_deviations_beyond_64_bits_are_exact_or_null():
    x = np.array([[2**40, 0], [0, 0], [5, 2**20]], np.int64)
    sums = [int(s) for s in x.sum(0)]
    want = [sum((3 * c - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    assert deviations(x, 3, sums) == [value if value < 2**63 else None for value in want]
    assert None in deviations(x, 3, sums)


def test_more_tasks_than_one_merges(spark, monkeypatch, vectors):
    monkeypatch.setattr(whitening, "FAN", 2)
    rows = spark.createDataFrame([(*row, 1) for row in vectors], COLUMNS)
    assert whiten(rows).first()["identity_error"] < 1e-10
