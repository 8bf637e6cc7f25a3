"""Quality, toxicity, LM scores, embeddings and urls against held-out rows or brute force."""

import math
import re

import numpy as np
import pyarrow as pa

from strata.llm import embed_dedup, quality, toxicity, url_filter

from .helpers import MEDIUM, PROSE, SMALL, doc, frame, odd_rows


def tables(spark, folder=MEDIUM):
    return (spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet"))


def area(scores, truth):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    for s in set(scores):  # ties share their mean rank
        same = np.array(scores) == s
        rank[same] = rank[same].mean()
    truth = np.array(truth)
    good, bad = truth.sum(), len(truth) - truth.sum()
    return (rank[truth == 1].sum() - good * (good + 1) / 2) / (good * bad)


# ---------------------------------------------------------------- quality


def test_quality_ranks_held_out_rows(spark):
    docs, labels = tables(spark)
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    got = quality.quality(docs, labels).collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert area([r["score"] for r in held], [truth[r["doc_id"]] for r in held]) > 0.8
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in got)


def test_quality_odd_rows(spark):
    docs, none = frame(spark, odd_rows()), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = quality.quality(docs, none).collect()
    assert len(got) == len(odd_rows()) and {(r["score"], r["predicted"]) for r in got} == {(0.5, 0)}
    some = spark.createDataFrame([(7, 1, 0), (7, 0, 0), (4, 0, 0), (None, 1, 1), (12, 1, None), (1, None, 0)],
                                 "doc_id long, quality int, toxic int")
    assert len(quality.quality(docs, some).collect()) == len(odd_rows())
    assert quality.quality(frame(spark, []), some).collect() == []


def test_isotonic_pooling():
    pooled = quality.pool_adjacent(np.array([.2, .1, .5, .4, .9]), np.ones(5))
    assert np.allclose(pooled, [.15, .15, .45, .45, .9], rtol=0, atol=1e-12)
    assert np.allclose(quality.pool_adjacent(np.array([1., 0.]), np.array([1., 3.])), 0.25)


def test_statistics_of_whole_texts():
    x = quality.statistics(pa.array([None, "", "a a a b\na a a b\nX!", "a" * 3_000_000]))
    names = quality.STATISTICS
    assert not x[:2].any()
    assert math.isclose(x[2, names.index("distinct")], 3 / 9)
    assert math.isclose(x[2, names.index("repeated_lines")], 1 / 3)
    assert math.isclose(x[3, names.index("log_bytes")], math.log1p(3_000_000))


# ---------------------------------------------------------------- toxicity


def test_toxicity_ranks_held_out_rows(spark):
    docs, labels = tables(spark)
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    got = toxicity.toxicity(docs, labels).collect()
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(got) == docs.count()
    assert area([r["score"] for r in held], [truth[r["doc_id"]] for r in held]) > 0.75
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got)


def test_toxicity_odd_rows(spark):
    docs, none = frame(spark, odd_rows()), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.toxicity(docs, none).collect()
    assert len(got) == len(odd_rows()) and {(r["score"], r["predicted"]) for r in got} == {(0.0, 0)}
    some = spark.createDataFrame([(7, 1, 0), (7, 0, 1), (4, 0, 0), (None, 1, 1), (12, 1, None)],
                                 "doc_id long, quality int, toxic int")
    assert len(toxicity.toxicity(docs, some).collect()) == len(odd_rows())
    assert toxicity.toxicity(frame(spark, []), some).collect() == []


def test_labels_of_no_document(spark):
    """Labels that fit none of the documents teach nothing."""
    docs = frame(spark, odd_rows())
    others = spark.createDataFrame([(900_000 + i, i % 2, (i + 1) % 2) for i in range(8)],
                                   "doc_id long, quality int, toxic int")
    assert {(r["score"], r["predicted"]) for r in toxicity.toxicity(docs, others).collect()} == {(0.0, 0)}
    assert {(r["score"], r["predicted"]) for r in quality.quality(docs, others).collect()} == {(0.5, 0)}


def test_label_model_finds_voters_and_correlations():
    rng = np.random.default_rng(7)
    truth = rng.random(4000) < 0.15
    fire = np.where(truth[:, None], [.6, .5, .4, .4], [.01, .01, .02, .02])
    votes = (rng.random((4000, 4)) < fire).astype(float)
    votes = np.hstack([votes, votes[:, 3:4]])  # a voter that repeats another
    posterior, share = toxicity.label_model(votes, 0.15)
    assert np.mean((posterior > 0.5) == truth) > 0.9
    assert share[3] < share[0] and share[4] < share[0]


# ---------------------------------------------------------------- embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, weight double, key string, rep long"


def vectors(rng):
    rows, n = [], 0
    for label in (1, 2):
        for _ in range(12):
            centre = rng.normal(size=24)
            for k in range(int(rng.integers(1, 9))):
                v = centre + rng.normal(size=24) * np.linalg.norm(centre) * rng.choice([0.01, 0.03, 0.045])
                rows.append((n, v.astype(np.float32).tolist(), label, 1.0, "k", 3))
                n += 1
    rows += [(n + i, rows[5][1], 1, 0.0, None, None) for i in range(20)]  # exact copies
    n += 20
    rows += [(n, [2 * x for x in rows[5][1]], 1, 0., "", 1), (n + 1, None, 1, 0., "", 1), (n + 2, [], 1, 0., "", 1),
             (n + 3, [0.0] * 24, 1, 0., "", 1), (n + 4, [None] + rows[5][1][1:], 1, 0., "", 1),
             (n + 5, [float("nan")] + rows[5][1][1:], 1, 0., "", 1),
             (n + 6, [float("inf")] + rows[5][1][1:], 1, 0., "", 1), (n + 7, rows[5][1], None, 0., "", 1),
             (n + 8, rows[5][1], 2, 0., "", 1), (n + 9, rows[5][1][:12], 1, 0., "", 1)]
    return rows


def brute_links(rows):
    ok = {}
    for i, v, label, *_ in rows:
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v):
            u = np.array(v, float)
            ok[i] = (label, u / np.linalg.norm(u))
    links = {r[0]: [] for r in rows}
    for i, (li, u) in ok.items():
        for j, (lj, w) in ok.items():
            if i != j and li == lj and len(u) == len(w) and u @ w >= 0.98:
                links[i].append(j)
    best = {i: i for i in links}
    changed = True
    while changed:
        changed = False
        for i, js in links.items():
            low = min([best[i], *(best[j] for j in js)])
            for k in [i, *js]:
                changed |= best[k] != low
                best[k] = low
    return {i: len(j) for i, j in links.items()}, best


def test_embeddings_match_brute_force(spark):
    rows = vectors(np.random.default_rng(8))
    count, best = brute_links(rows)
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    found = sum(r["n_links"] for r in got)
    assert all(r["n_links"] <= count[r["vec_id"]] for r in got)
    assert found >= 0.97 * sum(count.values())
    assert np.mean([r["component_id"] == best[r["vec_id"]] for r in got]) >= 0.97
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in got)
    last = {r["vec_id"]: r for r in got}
    for r in rows[-9:-2]:
        assert (last[r[0]]["n_links"], last[r[0]]["component_id"]) == (0, r[0])


def test_embeddings_recall_on_random_near_pairs():
    """Pairs at the threshold itself, the hardest ones, meet in a bucket."""
    rng = np.random.default_rng(2)
    base = rng.normal(size=(3000, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    step = rng.normal(size=base.shape)
    step -= (step * base).sum(axis=1, keepdims=True) * base
    step /= np.linalg.norm(step, axis=1, keepdims=True)
    near = 0.981 * base + math.sqrt(1 - 0.981 ** 2) * step
    q = embed_dedup.fit(base)
    x = q.codes(base) ^ q.codes(near)
    agree = sum(((x & np.uint64(m)) == 0).astype(int) for m in q.chunk_masks())
    on = np.array([bin(int(v)).count("1") for v in x])
    assert np.mean((agree >= 2) & (on <= embed_dedup.FURTHEST)) > 0.9
    assert abs(np.mean([bin(int(c)).count("1") for c in q.codes(base)]) - 32) < 1.5  # balanced bits


def test_embeddings_empty(spark):
    assert embed_dedup.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(1, None, 1, 0., "", 1)], SCHEMA)
    assert [tuple(r) for r in embed_dedup.near_duplicates(one).collect()] == [(1, 0, 1, True)]


# ---------------------------------------------------------------- urls


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    fits = [r for r in url_filter.RULES
            if (host == r.split("/")[0] or host.endswith("." + r.split("/")[0]))
            and path.startswith("/" + r.split("/", 1)[1])]
    return max(fits, key=len, default=None)


ODD_URLS = [None, "", "no scheme", "http://", "https://Example.NET/en/x", "https://a.example.net/en", "http://net/",
            "http://a.net", "http://a.net?x", "http://planet/", "ftp://Ä.example.com/de/?q#f", "a://b://c.org/fr/1",
            "http://x.org/fr/2#top", "http://example.com/de/9", "http://notexample.com/de/9", "http://a.org/FR/"]


def test_urls_match_brute_force(spark):
    pages = [(r["page_id"], r["url"]) for r in
             spark.read.parquet(f"{MEDIUM}/pages.parquet").select("page_id", "url").collect()]
    pages += [(100_000 + i, u) for i, u in enumerate(ODD_URLS)] + [(100_003, ODD_URLS[3])]
    table = spark.createDataFrame([(i, u, "h", 1.0, "p") for i, u in pages],
                                  "page_id long, url string, html string, score double, host string")
    got = url_filter.judge(table).collect()
    assert len(got) == len(pages)
    url = dict(pages)
    for r in got:
        host, path = plain_parts(url[r["page_id"]])
        rule = plain_rule(host, path)
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] in ("allow", "block")
        if rule:
            assert r["verdict"] == url_filter.RULES[rule]
    covered = [(r["score"], r["verdict"] == "allow") for r in got if r["rule"]]
    assert area([s for s, _ in covered], [int(v) for _, v in covered]) > 0.95


def test_urls_without_examples(spark):
    schema = "page_id long, url string"
    only = spark.createDataFrame([(1, "http://a.com/x"), (2, None), (3, "http://a.net/")], schema)
    assert {r["page_id"]: r["verdict"] for r in url_filter.judge(only).collect()} == {1: "allow", 2: "allow", 3: "block"}
    assert url_filter.judge(spark.createDataFrame([], schema)).collect() == []


def test_markov_model_is_a_distribution():
    index, at = url_filter._contexts(pa.array(["abc", None, "ab/9"]))
    assert np.diff(at).tolist() == [4, 1, 5]
    counts = np.bincount(index, minlength=url_filter.SYMBOLS ** (url_filter.ORDER + 1)).astype(float)
    p = np.exp(url_filter._log_model(counts)).reshape(-1, url_filter.SYMBOLS)
    assert np.allclose(p.sum(axis=1), 1, atol=1e-6)
