"""Exact sums against fractions, and Lloyd rounds over cell trees against rounds that test every point."""

import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from conftest import points_df
from locus.functions import centers as C, exact
from locus.functions.celltree import Tree, build, kd_order, LEAF
from locus.operators import elbow, kmeans as km


def slot_totals(sums, n):
    return [exact.total((b, s[j]) for b, s in sums.bins.items()) for j in range(n)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=64), max_size=60))
def test_sums_are_exact_for_any_doubles(terms):
    sums = exact.Sums(2)
    x = np.array(terms, np.float64)
    sums.add(np.arange(len(x)) % 2, x)
    assert slot_totals(sums, 2) == [sum(map(Fraction, terms[j::2]), Fraction(0)) for j in range(2)]


def test_whole_numbers_of_a_bin_are_added_as_integers(monkeypatch):
    monkeypatch.setattr(exact, "CHUNK", 7)
    rng = np.random.default_rng(1)
    x = rng.normal(size=1000) * 10.0 ** rng.integers(-12, 13, 1000)
    sums = exact.Sums(1)
    sums.add(np.zeros(1000, np.int64), x)
    sums.add_whole(3, np.zeros(2, np.int64), np.array([1 << 61, -5]))
    assert slot_totals(sums, 1) == [sum(map(Fraction, x.tolist())) + ((1 << 61) - 5) * Fraction(2) ** 90]


def test_tasks_sums_cannot_overflow(spark):
    # Sums of 2^34 rows and more: each task may give up to 2^61 in a bin.
    rows = spark.range(0, 4096, 1, 8).selectExpr("1 AS k", "1 AS center_id", "CAST(0 AS INT) AS dim", "0 AS bin",
                                                 "CAST(2305843009213693951 AS BIGINT) AS whole")
    [row] = C.merged_sums(rows).collect()
    assert int(row["whole"]) == 4096 * (2 ** 61 - 1)


def mixed(n, seed):
    rnd = random.Random(seed)
    return [(rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-12, 12), rnd.uniform(-1, 1) * 10.0 ** rnd.randint(-12, 12)) for _ in range(n)]


def test_mixed_magnitudes_give_the_same_bits_and_match_fractions(spark):
    pts = mixed(2000, 3)
    df = points_df(spark, pts)
    cs = {3: [(1, 0.0, 0.0), (2, 1e9, 1e9), (3, -1e10, 3.0)]}
    owner = [min(cs[3], key=lambda c: ((c[1] - x) * (c[1] - x) + (c[2] - y) * (c[2] - y), c[0])) for x, y in pts]
    want = {}
    for c in cs[3]:
        mine = [p for p, o in zip(pts, owner) if o == c]
        want[c[0]] = tuple(float(sum(Fraction(p[i]) for p in mine) / len(mine)) for i in range(2))
    d2 = [(c[1] - x) * (c[1] - x) + (c[2] - y) * (c[2] - y) for (x, y), c in zip(pts, owner)]
    for n in (1, 7, 17):
        part = df.repartition(n)
        got = {r["center_id"]: (r["cx"], r["cy"]) for r in km.update_centers(part, cs).collect()}
        assert got == want
        rounds = km.CellRounds(part, "x", "y", None)
        assert {c[0]: c[1:] for c in rounds.update(cs)[3]} == want
        rounds.close()
        assert elbow.wcss_curve(part, cs).first()["wcss"] == float(sum(map(Fraction, d2)))
        assert elbow.prefix_curve(part, [(1, 0.0, 0.0)], 1, 1).first()["wcss"] == float(
            sum(Fraction(x * x + y * y) for x, y in pts))


def brute_sums(xs, ys, ws, by_k):
    flat = C.Flat(by_k)
    sums = [exact.Sums(flat.size) for _ in range(3)]
    owners = flat.nearest(xs, ys)[0]
    for j in range(len(flat.ks)):
        for acc, terms in zip(sums, (xs * ws, ys * ws, ws)):
            acc.add(owners[:, j], terms)
    return [slot_totals(s, flat.size) for s in sums]


CLOUDS = {
    "lattice with ties": lambda rng, n: rng.integers(0, 9, (2, n)).astype(float),
    "one far outlier": lambda rng, n: np.concatenate([rng.normal(size=(2, n - 1)), [[1e9], [-1e9]]], axis=1),
    "a third at one place": lambda rng, n: np.where(rng.random(n) < 1 / 3, 5.0, rng.uniform(0, 10, (2, n))),
    "a line": lambda rng, n: np.stack([np.arange(n, dtype=float), np.zeros(n)]),
    "mixed magnitudes": lambda rng, n: rng.normal(size=(2, n)) * 10.0 ** rng.integers(-12, 13, n),
}


@pytest.mark.parametrize("cloud", CLOUDS)
@pytest.mark.parametrize("n", [1, LEAF, LEAF + 1, 5000])
def test_cells_give_what_testing_every_point_gives(cloud, n, monkeypatch):
    import locus.functions.celltree as ct
    monkeypatch.setattr(ct, "TESTED", 50)
    rng = np.random.default_rng(n)
    xs, ys = CLOUDS[cloud](rng, max(n, 2))[:, :n]
    ws = rng.integers(1, 5, n) * 0.5
    at = lambda k: rng.integers(0, n, k)
    by_k = {k: [(i + 1, float(xs[j]) + (i % 3) * 0.5, float(ys[j])) for i, j in enumerate(at(k))] for k in (1, 2, 5, 20)}
    tree = Tree.of(xs, ys, ws)
    flat = C.Flat(by_k)
    sums = [exact.Sums(flat.size) for _ in range(3)]
    tree.assign(flat, sums)
    assert [slot_totals(s, flat.size) for s in sums] == brute_sums(xs, ys, ws, by_k)


def test_fewer_distance_tests(capsys):
    rng = np.random.default_rng(2)
    xs, ys = rng.uniform(0, 1000, (2, 100_000))
    by_k = {k: [(i + 1, *map(float, rng.uniform(0, 1000, 2))) for i in range(k)] for k in range(5, 21)}
    flat = C.Flat(by_k)
    tests = Tree.of(xs, ys, np.ones(len(xs))).assign(flat, [exact.Sums(flat.size) for _ in range(3)])
    print(f"{tests} tests in place of {len(xs) * flat.size}")
    assert tests * 20 < len(xs) * flat.size


def test_order_is_a_permutation_of_tight_cells():
    rng = np.random.default_rng(3)
    xs, ys = rng.uniform(0, 1, (2, 3000))
    order = kd_order(xs, ys)
    assert sorted(order) == list(range(3000))
    boxes = Tree.of(xs, ys, np.ones(3000)).boxes[:-(-3000 // LEAF)]
    area = ((boxes[:, 1] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 2])).sum()
    assert area < 1.0


def test_a_round_is_one_job_and_many_tasks_are_summed_in_spark(spark, monkeypatch):
    pts = [(float(i % 37), float(i % 53)) for i in range(600)]
    df = points_df(spark, pts).repartition(9)
    inits = {2: [(1, 0.0, 0.0), (2, 30.0, 30.0)], 3: [(1, 0.0, 0.0), (2, 30.0, 30.0), (3, 5.0, 50.0)]}
    want = {k: f.centers for k, f in km.kmeans_sweep(df, inits, max_iter=3).items()}
    monkeypatch.setattr(km.CellRounds, "TASKS_PER_SUM", 1)
    stats = {}
    assert {k: f.centers for k, f in km.kmeans_sweep(df, inits, max_iter=3, stats=stats).items()} == want
    assert stats["rounds"] == 3 and stats["tests"] > 0
    rounds = km.CellRounds(df, "x", "y", None)
    rounds.update(inits)
    sc = spark.sparkContext
    sc.setJobGroup("one round", "one round")
    rounds.update(inits)
    assert len(sc.statusTracker().getJobIdsForGroup("one round")) == 1
    sc.setLocalProperty("spark.jobGroup.id", None)
    rounds.close()


def test_trees_split_at_their_bound_and_empty_input(spark, monkeypatch):
    import locus.functions.celltree as ct
    monkeypatch.setattr(ct, "TREE", 100)
    df = points_df(spark, [(i, i) for i in range(250)]).coalesce(1)
    assert sorted(r["n"] for r in build(df).collect()) == [50, 100, 100]
    empty = points_df(spark, [])
    assert build(empty).count() == 0
    assert km.kmeans_sweep(empty, {1: [(1, 0.0, 0.0)]})[1].centers == []
