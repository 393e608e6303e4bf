from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pytest

from touchledger.llm import whitening as wh

SCHEMA = "vec_id bigint, embedding array<float>"


def grid(vectors):
    return [[floor(Fraction(float(np.float32(c))) * 1024) + 100_000 for c in v] for v in vectors]


def by_hand(x):
    """Covariances as fractions, products of centred values entry by entry, and deviations."""
    n, d = len(x), len(x[0])
    sums = [sum(r[i] for r in x) for i in range(d)]
    centred = [[n * r[i] - sums[i] for i in range(d)] for r in x]
    cov = [[Fraction(sum(r[i] * r[j] for r in centred), n ** 3) for j in range(d)] for i in range(d)]
    return sums, cov, [sum(c * c for c in r) for r in centred]


def frame(llm, vectors, schema=SCHEMA):
    return llm.createDataFrame([(i, v) for i, v in enumerate(vectors)], schema)


def random_vectors(n, d, seed=1):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) * 0.3
    return [[float(np.float32(c)) for c in v] for v in mixed]


def test_equal_to_the_definition(llm):
    vectors = random_vectors(300, 12)
    rows = wh.whiten(frame(llm, vectors)).collect()
    x = grid(vectors)
    sums, cov, deviations = by_hand(x)
    values, directions = np.linalg.eigh(np.array([[float(c) for c in r] for r in cov]))
    values, directions = values[::-1], directions[:, ::-1]
    want = (np.array(x, float) - np.array(sums) / 300) @ directions / np.sqrt(values)
    assert len(rows) == 300 * 8
    sign = {}
    for r in rows:
        k = r["component"] - 1
        sign.setdefault(k, np.sign(r["whitened"] * want[r["vec_id"], k]))
        assert r["n"] == 300 and r["deviation"] == deviations[r["vec_id"]]
        assert r["whitened"] == pytest.approx(sign[k] * want[r["vec_id"], k], abs=1e-8)
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-10)
        assert 0 <= r["identity_error"] < 1e-9
    assert len({r["identity_error"] for r in rows}) == 1


def test_covariances_are_exact(llm):
    vectors = random_vectors(37, 5, 2)
    model = {}

    class Kept(wh.Whitening):
        def __init__(self, n, sums, covariance, components):
            model.update(n=n, sums=sums, covariance=covariance)
            super().__init__(n, sums, covariance, components)

    original, wh.Whitening = wh.Whitening, Kept
    try:
        wh.fit(wh.remaining(frame(llm, vectors), "vec_id", "embedding"))
    finally:
        wh.Whitening = original
    sums, cov, _ = by_hand(grid(vectors))
    assert model["sums"] == sums
    assert model["covariance"] == [[c * 37 * 37 for c in row] for row in cov]


def test_only_sums_and_pair_sums_are_squared():
    x = np.array([[1, 2, -3], [4, 0, 5]])
    assert wh.pair_squares(x).tolist() == [17, 25, 85, 4, 26, 34]
    huge = np.array([[1 << 40, -(1 << 41), 3]])
    assert wh.pair_squares(huge).tolist() == [1 << 80, 1 << 80, ((1 << 40) + 3) ** 2, 1 << 82, (3 - (1 << 41)) ** 2, 9]


def test_limbs_add_up():
    totals = np.array([0, 5, -7, (1 << 100) + 3, -(1 << 64), 1 << 32], object)
    back = [0] * 6
    for batch in wh.limbs(totals, ["place", "limb", "value"]):
        for r in batch.to_pylist():
            back[r["place"]] += r["value"] << 32 * r["limb"]
    assert back == totals.tolist()


def test_unusable_vectors_ties_and_clashing_columns(llm):
    good = random_vectors(40, 3, 3)
    rows = [(i, v, 1, i) for i, v in enumerate(good)]
    rows += [(7, good[7], 1, 7), (None, good[8], 1, None), (100, None, 1, 0), (101, [], 1, 0), (102, [1.0, None, 2.0], 1, 0),
             (103, [1.0, nan, 2.0], 1, 0), (104, [inf, 0.0, 0.0], 1, 0), (105, [0.0, -inf, 0.0], 1, 0), (106, [1.0, 2.0], 1, 0)]
    got = wh.whiten(llm.createDataFrame(rows, SCHEMA + ", component int, n bigint")).collect()
    assert len(got) == 42 * 3 and {r["n"] for r in got} == {42}
    assert {r["vec_id"] for r in got} == {*range(40), None}
    _, _, deviations = by_hand(grid([*good, good[7], good[8]]))
    assert {r["deviation"] for r in got if r["vec_id"] == 7} == {deviations[7]}
    assert len([r for r in got if r["vec_id"] == 7]) == 6
    assert max(r["identity_error"] for r in got) < 1e-9


@pytest.mark.parametrize("vectors", [[], [None, []], [[1.0, 2.0]], [[1.0, 2.0]] * 5])
def test_no_variance_no_component(llm, vectors):
    assert wh.whiten(frame(llm, vectors)).collect() == []


def test_fewer_components_than_dimensions(llm):
    vectors = [[float(i), float(2 * i), float(j)] for i in range(5) for j in range(3)]
    got = wh.whiten(frame(llm, vectors)).collect()
    assert {r["component"] for r in got} == {1, 2} and max(r["identity_error"] for r in got) < 1e-6
    assert {r["component"] for r in wh.whiten(frame(llm, vectors), components=1).collect()} == {1}


def test_grid_of_odd_and_huge_entries():
    values = np.array([[0.0, -0.0, -1e-9, 0.9999, -0.5]])
    assert wh.on_grid(values).tolist() == [[100_000, 100_000, 99_999, 100_000 + 1023, 100_000 - 512]]
    huge = wh.on_grid(np.array([[3e38, -3e38, 1.7e308, -1.7e308, 2.0 ** 50]]))
    assert huge.tolist() == [[2**63 - 1, -2**63, 2**63 - 1, -2**63, 2**60 + 100_000]]


def test_huge_entries_stay_exact(llm):
    vectors = [[3e38, 1.0], [-3e38, 2.0], [1.0, 3.0], [0.5, -4.0]]
    got = wh.whiten(frame(llm, vectors)).collect()
    assert {r["component"] for r in got} == {1} and max(r["identity_error"] for r in got) < 1e-6
    _, _, deviations = by_hand([[min(max(c, -2**63), 2**63 - 1) for c in row] for row in grid(vectors)])
    assert {(r["vec_id"], r["deviation"]) for r in got} == {(i, v if v < 2**63 else None) for i, v in enumerate(deviations)}
    assert {r["deviation"] for r in got if r["vec_id"] < 2} == {None}
    medium = [[1e6, 1.0], [-1e6, 2.0], [1.0, 3.0], [0.5, -4.0]]
    _, _, deviations = by_hand(grid(medium))
    got = wh.whiten(frame(llm, medium)).collect()
    assert {(r["vec_id"], r["deviation"]) for r in got} == {(i, v if v < 2**63 else None) for i, v in enumerate(deviations)}


def test_result_does_not_depend_on_the_partitions(llm):
    vectors = frame(llm, random_vectors(200, 6, 9))
    a, b = ({(r["vec_id"], r["component"]): (r["deviation"], abs(r["whitened"]), r["explained"])
             for r in wh.whiten(vectors.repartition(n)).collect()} for n in (1, 7))
    assert a == b
