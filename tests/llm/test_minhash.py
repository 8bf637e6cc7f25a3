import re

import numpy as np
import pyarrow as pa

from strata.llm import minhash
from strata.llm.components import connected_components
from strata.llm.textscan import slices, text_buffer

from .helpers import PROSE, SCHEMA, SMALL, doc, frame, odd_rows


def brute_sets(texts):
    out = []
    for t in texts:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        w = re.findall(r"[^\x20\x09-\x0D]+", low)
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute_components(ids, sets):
    best = {i: i for i in ids}
    links = [(ids[x], ids[y]) for x in range(len(ids)) for y in range(x)
             if sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= 75 * len(sets[x] | sets[y])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(best[a], best[b])
            changed |= best[a] != low or best[b] != low
            best[a] = best[b] = low
    return best


def test_shingle_sets_count_like_brute_force():
    texts = [r[1] for r in odd_rows()] + [PROSE.replace(" ", "\x0b"), "a b c d", "a b c d e", "A  B\nc d e f"]
    got = minhash.shingle_sets(pa.array(texts))
    want = brute_sets(texts)
    assert [len(g) for g in got] == [len(w) for w in want]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(got[i], got[j])) == len(want[i] & want[j])


def test_sketch_estimates_high_similarity():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 63, 2000).astype(np.uint64))
    keep = base[: int(len(base) * 0.9)]
    extra = np.unique(rng.integers(0, 1 << 63, len(base) - len(keep)).astype(np.uint64))
    other = np.concatenate([keep, extra])
    a, b = minhash.odd_sketches(np.stack([minhash.minhash(base), minhash.minhash(other)]))
    differ = sum(bin(int(x) ^ int(y)).count("1") for x, y in zip(a, b))
    n, k = minhash.SKETCH_BITS, minhash.SAMPLES
    estimate = 1 + np.log(1 - 2 * differ / n) * n / 4 / k
    assert abs(estimate - len(keep) / (2 * len(base) - len(keep))) < 0.12


def test_slices_keep_every_row_and_bound_text():
    batch = pa.record_batch({"text": pa.array(["x" * 400_000] * 9 + [None, "", "y" * 3_000_000])})
    pieces = list(slices(batch))
    assert sum(p.num_rows for p in pieces) == batch.num_rows
    assert all(len(text_buffer(p.column("text"))[0]) <= 1 << 20 or p.num_rows == 1 for p in pieces)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 1000), (5, 5), (2, 1)] + [(i, i + 1) for i in range(20, 60)]
    got = {r["node"]: r["component"] for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 9: 7, 8: 7, 7: 7, 1000: 7} | {i: 20 for i in range(20, 61)}


def near_group():
    """A group whose members link only through some others, and a pair just below the threshold."""
    words = [f"t{i}" for i in range(120)]
    rows = [doc(100, " ".join(words))]
    for k in range(1, 13):  # each replaces a block of words; neighbours stay similar
        w = list(words)
        w[3 * k:3 * k + 2 * k] = [f"u{k}_{i}" for i in range(2 * k)]
        rows.append(doc(100 + k, " ".join(w)))
    return rows


def test_matches_brute_force(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    rows = odd_rows() + near_group() + [doc(10_000 + r["doc_id"], r["text"]) for r in table]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    own = [r for r in rows if r[0] is not None]
    sets = brute_sets([r[1] for r in own])
    best = brute_components([r[0] for r in own], sets)
    size = {r[0]: len(s) for r, s in zip(own, sets)}
    for r in got:
        if r["doc_id"] is None:
            assert r["component_id"] == 7 and r["kept"]
        else:
            assert (r["component_id"], r["n_shingles"]) == (best[r["doc_id"]], size[r["doc_id"]])
            assert r["kept"] == (best[r["doc_id"]] == r["doc_id"])


def test_empty_table_and_columns(spark):
    empty = frame(spark, [])
    assert minhash.near_duplicates(empty).collect() == []
    kept = minhash.drop_near_duplicates(frame(spark, odd_rows()))
    assert kept.schema.simpleString() == frame(spark, []).schema.simpleString()
    ids = [r["doc_id"] for r in kept.collect()]
    assert set(ids) == {1, 2, 3, 4, 6, 7, 11, 12, 14, None}
    assert SCHEMA.split()[0] == "doc_id"
