import itertools

import numpy as np
import pytest

from ledgerlens.llm import ann, queries

SF = "/root/testdata/sf0.01"


def brute(vectors, query, k):
    """[(score, id)] of the nearest, ids once."""
    u = np.array(vectors[query], np.float64)
    far = sorted((float(np.sqrt(np.square(np.array(v, np.float64) - u).sum())), i) for i, v in vectors.items()
                 if i != query)
    return far[:k]


def test_hilbert_is_a_curve():
    for axes, bits in ((2, 3), (3, 2), (4, 2)):
        grid = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
        key = ann.hilbert(grid, bits)
        assert sorted(key) == list(range(len(grid)))
        steps = np.abs(np.diff(grid[np.argsort(key)], axis=0)).sum(axis=1)
        assert (steps == 1).all()


def test_query_recall(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    vectors = {r.vec_id: r.embedding for r in rows}
    got = queries.op8_nearest_neighbours(spark, SF).collect()
    hit = total = 0
    for q in (i for i in vectors if i % 100 == 0):
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[0] for m in mine] == list(range(1, 11))
        truth = brute(vectors, q, 10)
        hit += len({m[1] for m in mine} & {i for _, i in truth})
        total += 10
    assert hit / total >= 0.9


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(60, 24))
    return {i: [float(x) for x in np.float32(centres[i % 60] + 0.15 * rng.normal(size=24))] for i in range(6000)}


def test_narrow_windows_find_clusters(spark, clustered):
    """Windows that hold a fifth of the table between them still find the neighbours."""
    df = spark.createDataFrame(list(clustered.items()), "vec_id long, embedding array<float>")
    got = ann.neighbours(spark, df, lambda i: i % 100 == 0, curves=8, share=0.01, least=1).collect()
    hit = 0
    for q in range(0, 6000, 100):
        mine = {r.vec_id: r.score for r in got if r.query_id == q}
        for score, i in brute(clustered, q, 10):
            hit += i in mine
            assert i not in mine or mine[i] == pytest.approx(score, abs=1e-12)
    assert hit / 600 >= 0.9


def test_defined_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], "x"), (1, [1.0, 0.0], "x"), (2, [0.0, 1.0], "x"), (2, [0.0, 1.0], "x"), (3, None, "x"),
            (4, [0.0, 0.0], "x"), (5, [nan, 1.0], "x"), (6, [inf, 1.0], "x"), (7, [None, 1.0], "x"), (8, [1.0], "x"),
            (None, [3.0, 3.0], "x"), (9, [], "x"), (100, [2.0, 0.0], None), (100, [2.0, 0.5], None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score string")
    got = {}
    for r in ann.neighbours(spark, df, lambda i: i % 100 == 0).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, round(r.score, 6)))
    assert set(got) == {0, 100}
    assert sorted(got[0]) == [(1, 1, 0.0), (2, 100, 1.0), (3, 2, 1.414214)]
    assert sorted(got[100]) == [(1, 0, 1.0), (2, 1, 1.0), (3, 2, 2.061553)]
    assert ann.neighbours(spark, df.where("false"), lambda i: i % 100 == 0).count() == 0
    assert ann.neighbours(spark, df.where("vec_id = 3"), lambda i: i % 100 == 0).count() == 0


def test_a_vector_that_many_rows_have(spark):
    """Copies beyond a window's size: the nearest are the smallest ids, whatever lies between."""
    rng = np.random.default_rng(9)
    same = [float(x) for x in np.float32(rng.normal(size=12))]
    rows = [(i, same if i % 3 == 0 else [float(x) for x in np.float32(rng.normal(size=12))]) for i in range(3000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = ann.neighbours(spark, df, lambda i: i % 100 == 0, curves=4, share=0.01, least=64).collect()
    copies = [i for i in range(3000) if i % 3 == 0]
    for q in range(0, 3000, 300):
        mine = [r.vec_id for r in sorted(got, key=lambda r: r.rank) if r.query_id == q]
        assert mine == [i for i in copies if i != q][:10]


@pytest.mark.parametrize("noise", [0.0001, 0.001])
def test_a_tight_group_of_distinct_vectors(spark, noise):
    """A third of all rows lie near one vector: their neighbours are found within the group."""
    rng = np.random.default_rng(11)
    x = rng.normal(size=(20_000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[::3] = x[0] + noise * rng.normal(size=x[::3].shape)
    x = np.float32(x)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {}
    for r in ann.neighbours(spark, df, lambda i: i % 600 == 0).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hit = 0
    for q in range(0, 20_000, 600):
        far = np.square(x.astype(np.float64) - x[q]).sum(axis=1)
        far[q] = np.inf
        hit += len(got[q] & set(np.argsort(far)[:10].tolist()))
    assert hit / (10 * len(got)) >= 0.9
