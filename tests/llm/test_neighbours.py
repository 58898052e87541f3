import numpy as np
import pytest

from reachgrid.llm import neighbours

FOLDER = "/root/testdata/sf0.01"


def brute(rows, asked, k):
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], float)
    norms = np.sqrt((vectors**2).sum(1))
    out = {}
    for key, vector in asked:
        scores = (vectors * np.array(vector, float)).sum(1) / (norms * np.sqrt((np.array(vector) ** 2).sum()))
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != key][:k]
        out[key] = [(int(ids[i]), float(scores[i])) for i in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    good = [(i, [float(i % 3), 1.0, float(i)]) for i in range(1, 6)] + [(6, [1.0, 1.0, 1.0]), (7, [2.0, 2.0, 2.0])]
    bad = [(20, None), (21, [0.0, 0.0, 0.0]), (22, [1.0, None, 1.0]), (23, [nan, 1.0, 1.0]),
           (24, [inf, 1.0, 1.0]), (None, [1.0, 1.0, 1.0]), (25, [1.0, 1.0]), (26, [])]
    rows = good + bad + [good[0]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, key int, n string")
    got = found(neighbours.nearest(df, df, k=3))
    want = brute(good, good, 3)
    assert set(got) == set(want)
    for key in want:
        assert [i for i, _ in got[key]] == [i for i, _ in want[key]], key
        assert np.allclose([s for _, s in got[key]], [s for _, s in want[key]])
    few = found(neighbours.nearest(df.filter("vec_id IN (1, 2)"), df.filter("vec_id = 1"), k=5))
    assert set(few) == {1} and [i for i, _ in few[1]] == [2]
    assert neighbours.nearest(df.limit(0), df).count() == 0
    assert neighbours.nearest(df, df.limit(0)).count() == 0


def test_equal_vectors_go_to_the_smaller_key(spark):
    rows = [(i, [0.3, 0.1, 0.7]) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = found(neighbours.nearest(df, df.filter("vec_id IN (0, 300)"), k=4))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4] and [i for i, _ in got[300]] == [0, 1, 2, 3]


@pytest.mark.parametrize("block", [128, 4096])
def test_recall(spark, block):
    df = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    asked = [r for r in rows if r[0] % 50 == 0]
    index = neighbours.build_index(neighbours.usable(df, "vec_id", "embedding"), block=block)
    queries = neighbours.usable(df.filter("vec_id % 50 = 0"), "vec_id", "embedding")
    got = found(neighbours.search(index, queries))
    want = brute(rows, asked, 5)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    assert index.selectExpr("sum(n)").first()[0] == len(rows)
