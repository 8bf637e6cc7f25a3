"""Heavy hitters, distinct sketches and length-bounded top lists against plain counting and scoring."""

from collections import Counter

import numpy as np
import pytest

from strata.operators import recommend as RE
from strata.operators import sketches as SK
from strata.session import task_heap


@pytest.mark.parametrize("support", [0.02, 0.1, 0.6])
def test_heavy_hitters_equal_a_full_count(spark, support):
    rng = np.random.default_rng(3)
    values = [*(int(v) for v in rng.zipf(1.3, 6_000) % 900), *[None] * 500, *[5] * 2_000]
    rng.shuffle(values)
    df = spark.createDataFrame([(None if v is None else int(v),) for v in values], "v long").repartition(13)
    counts = Counter(v for v in values if v is not None)
    total = sum(counts.values())
    want = {v: n for v, n in counts.items() if n >= support * total}
    assert {r.v: r.n for r in SK.heavy_hitters(df, "v", support).collect()} == want
    assert SK.heavy_hitter_candidates(df, "v", support).count() <= 2 / support + 1


def test_heavy_hitters_of_nothing(spark):
    df = spark.createDataFrame([(None,), (None,)], "v string")
    assert SK.heavy_hitters(df, "v", 0.1).count() == 0
    assert SK.heavy_hitters(df.limit(0), "v", 0.1).count() == 0


def test_sketches_of_days_unite_to_any_range(spark):
    df = spark.range(40_000).selectExpr("id % 7 AS day", "(id * 31) % 9001 AS host")
    days = SK.distinct_sketches(df, ["day"], "host")
    for most in (0, 3, 6):
        got = SK.distinct_estimates(days.where(f"day <= {most}").selectExpr("1 AS k", "sketch"), ["k"]).first()["n"]
        exact = df.where(f"day <= {most}").select("host").distinct().count()
        assert abs(got - exact) <= SK.relative_error() * exact


@pytest.mark.parametrize("block,blocks", [(3, 2), (7, 100), (4096, 16)])
def test_pruned_lists_are_those_of_full_scoring(spark, block, blocks):
    rng = np.random.default_rng(4)
    ratings = spark.createDataFrame([(int(u), int(i), float(rng.integers(1, 6))) for u in range(25) for i in range(40)
                                     if rng.random() < 0.4], "user_id int, item_id int, rating double")
    model = RE.als("user_id", "item_id", "rating", rank=3, max_iter=3).fit(ratings)
    users = {r.id: np.array(r.features, float) for r in model.userFactors.collect()}
    items = {r.id: np.array(r.features, float) for r in model.itemFactors.collect()}
    lists, share = RE.pruned_top_items(model, 5, block=block, blocks=blocks)
    got = {}
    for r in lists.orderBy("user_id", "rank").collect():
        got.setdefault(r.user_id, []).append((r.item_id, r.score))
    for u, x in users.items():
        want = sorted(((float(x @ v), -i) for i, v in items.items()), reverse=True)[:5]
        assert [i for i, _ in got[u]] == [-i for _, i in want]
        assert np.allclose([s for _, s in got[u]], [s for s, _ in want])
    row = share.first()
    assert row["pairs"] == len(users) * len(items) and 0 < row["scored"] <= row["pairs"]
    if block < 10:
        assert row["scored"] < row["pairs"]


def _small_model(spark):
    rng = np.random.default_rng(6)
    ratings = spark.createDataFrame([(int(u), int(i), float(rng.integers(1, 6))) for u in range(30) for i in range(50)
                                     if rng.random() < 0.4], "user_id int, item_id int, rating double")
    return RE.als("user_id", "item_id", "rating", rank=3, max_iter=3).fit(ratings)


def test_full_lists_score_every_pair_over_several_passes(spark, monkeypatch):
    monkeypatch.setattr(RE, "PASS_ITEMS", 256)
    rng = np.random.default_rng(5)
    users, items = (spark.createDataFrame([(i, [float(x) for x in rng.normal(size=4)]) for i in range(n)],
                                          "id int, features array<float>") for n in (40, 700))
    x, v = (np.array([r.features for r in f.orderBy("id").collect()]) for f in (users, items))
    got = {(r.user_id, r["rank"]): r.item_id for r in RE._all_lists(users, items, "user_id", "item_id", 5).collect()}
    for u in range(40):
        assert [got[u, k + 1] for k in range(5)] == sorted(range(700), key=lambda i: (-(x[u] @ v[i]), i))[:5]


def test_narrow_blocks_share_a_pass(spark, monkeypatch):
    model, passes = _small_model(spark), []
    plain = RE.written
    monkeypatch.setattr(RE, "written", lambda df, name: passes.append(name) or plain(df, name))
    RE.pruned_top_items(model, 5, block=2)
    assert passes.count("top-state") == 2  # the first state and one pass over all 25 blocks


def test_fits_drop_shuffles_and_use_few_blocks(spark, monkeypatch):
    assert RE.als("u", "i", "r").getCheckpointInterval() == 1
    monkeypatch.setattr(RE, "cluster_cores", lambda spark: 12)
    assert RE.als_blocks(spark.range(100)) == 12
    monkeypatch.setattr(RE, "FEW_RATINGS", 10)
    assert RE.als_blocks(spark.range(100)) == 6 and RE.als_blocks(spark.range(100), 3) == 3


def test_a_light_fit_takes_a_quarter_of_the_cores(spark, monkeypatch):
    monkeypatch.setattr(RE, "cluster_cores", lambda spark: 12)
    monkeypatch.setattr(RE, "FEW_RATINGS", 10)
    assert RE.als_blocks(spark.range(100), light=True) == 3 and RE.als_blocks(spark.range(5), light=True) == 12


def test_blocks_fit_the_heap_of_a_task(spark, monkeypatch):
    assert task_heap(spark) > 1 << 20
    monkeypatch.setattr(RE, "cluster_cores", lambda spark: 12)
    monkeypatch.setattr(RE, "FEW_RATINGS", 10)
    monkeypatch.setattr(RE, "task_heap", lambda spark: 5 * RE.RATING_BYTES)
    assert RE.als_blocks(spark.range(100)) == RE.als_blocks(spark.range(100), 3, light=True) == 20
    assert RE.als_blocks(spark.range(20), 3) == 4 and RE.als_blocks(spark.range(10)) == 6
    monkeypatch.setattr(RE, "task_heap", lambda spark: None)
    assert RE.als_blocks(spark.range(100)) == 6
