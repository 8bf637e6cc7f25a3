"""Cross-polytope search against brute force."""

import numpy as np
import pytest

from strata.llm import ann

from .helpers import MEDIUM

SCHEMA = "vec_id long, embedding array<float>, label int, code long, block long, score double, asks string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, 2, 0.5, "x") for i, v in rows], SCHEMA)


def sound(v):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)


def brute_force(rows, every=100):
    rows = [(i, v) for i, v in rows if i is not None and sound(v)]
    if not rows:
        return {}
    width = max(len(v) for _, v in rows)
    table = np.array([[*v, *[0.0] * (width - len(v))] for _, v in rows], np.float32).astype(float)
    ids = np.array([i for i, _ in rows])
    out = {}
    for q in np.unique(ids[ids % every == 0]):
        best = {}
        for mine in table[ids == q]:
            for i, d in zip(ids, np.sqrt(((table - mine) ** 2).sum(axis=1))):
                if i != q:
                    best[i] = min(best.get(i, np.inf), d)
        out[q] = sorted((d, i) for i, d in best.items())[:ann.K]
    return {q: near for q, near in out.items() if near}


def found(spark, rows, **more):
    out = {}
    for r in ann.nearest(frame(spark, rows), **more).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_whole_lists_where_every_bucket_is_probed(spark):
    rng = np.random.default_rng(1)
    rows = [(int(i), rng.normal(size=5).tolist()) for i in [*range(0, 700, 100), 7]]
    rows += [(None, rows[0][1]), (1, None), (2, []), (3, [0.0] * 5), (4, [1.0, None, 0.0, 0.0, 0.0]),
             (5, [float("nan")] * 5), (6, [float("inf"), 1.0, 1.0, 1.0, 1.0]), (200, rows[2][1]),
             (300, [9.0, 9.0, 9.0, 9.0, 9.0]), (8, rows[3][1]), (9, rows[3][1]), (10, rows[3][1][:3])]
    got, want = found(spark, rows), brute_force(rows)
    assert got.keys() == want.keys()
    for q in want:  # at most ten others: the search with all buckets must be exact
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert np.allclose([d for d, _ in got[q]], [d for d, _ in want[q]], rtol=1e-14, atol=0)


def test_ties_and_copies(spark):
    same = [(i, [1.0, 2.0, 2.0]) for i in range(0, 400)]
    got = found(spark, same)
    for q in (0, 100, 200, 300):
        assert got[q] == [(0.0, i) for i in [i for i in range(12) if i != q][:ann.K]]


@pytest.mark.parametrize("rows", [[], [(100, [1.0, 2.0])], [(None, None)]])
def test_nothing_to_find(spark, rows):
    assert found(spark, rows) == {}


def test_recall_of_all_rows_as_queries(spark):
    import pyarrow.parquet as pq
    table = pq.read_table(f"{MEDIUM}/embeddings.parquet").to_pylist()
    rows = [(r["vec_id"], r["embedding"]) for r in table]
    near = 40  # groups of near copies beside the scattered rows
    rng = np.random.default_rng(3)
    for g in range(30):
        base = np.asarray(rows[g][1])
        rows += [(10_000 + g * near + k, (base + rng.normal(scale=0.01, size=len(base))).tolist()) for k in range(near)]
    got, want = found(spark, rows, every=1), brute_force(rows, every=1)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert all(len(got[q]) == ann.K for q in want)
    assert hits / (ann.K * len(want)) >= 0.95


def test_hadamard_turns_keep_lengths_and_codes_are_nearest_axes():
    hasher = ann.Hasher.of(5)
    x = np.random.default_rng(4).normal(size=(50, 5)) * 1e200
    turned = hasher.turned(x)
    assert np.allclose(np.linalg.norm(turned, axis=-1), 1.0)
    codes = hasher.codes(turned)
    for t in range(ann.TABLES):
        signed = hasher.signed(turned[:, t])
        own = hasher.score(signed, codes[:, t])
        assert np.allclose(np.diag(own), np.abs(turned[:, t]).max(axis=-1).sum(axis=-1))
