"""Merkle manifest against a tree built leaf by leaf in Python."""

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest

from strata.llm import merkle

from .helpers import frame, odd_rows

COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, tampered=False):
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"]]
    if tampered and values[4] is not None:
        values[4] = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in values[4])
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([sha("".join(low[i:i + 8])) for i in range(0, len(low), 8)])
    return levels


def siblings(levels, i):
    for low in levels[:-1]:
        first = i // 8 * 8
        yield "".join(low[first:i]), "".join(low[i + 1:first + 8])
        i //= 8


def brute_force(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row["lang"]].append(row)
    langs = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in langs:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r)))
        trees[g] = levels_of([leaf_of(r) for r in groups[g]])
    top = levels_of([trees[g][-1][0] for g in langs])
    root = top[-1][0] if langs else None
    for at, g in enumerate(langs):
        for i, row in enumerate(groups[g]):
            path = [*siblings(trees[g], i), *siblings(top, at)]
            doc_id = row["doc_id"]
            node = leaf_of(row, doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0)
            for left, right in path:
                node = sha(left + node + right)
            yield (doc_id, leaf_of(row), trees[g][-1][0], root, sha("".join(a + b for a, b in path)), node,
                   node == root)


def check(spark, rows):
    df = frame(spark, rows)
    found = Counter(tuple(r) for r in merkle.tamper_check(df).select(COLUMNS).collect())
    assert found == Counter(brute_force([r.asDict() for r in df.collect()]))


def test_odd_rows(spark):
    check(spark, odd_rows())


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, None: 9}, {"a": 512, "b": 513, "c": 1, "é": 70}])
def test_shapes_of_trees(spark, sizes):
    rows, doc_id = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            doc_id += 7
            rows.append((doc_id, f"Text {doc_id}", lang, None if doc_id % 2 else "S", doc_id, *odd_rows()[0][5:]))
    check(spark, rows)


def test_many_groups_form_several_levels(spark):
    check(spark, [(i, f"T{i}", f"lang{i % 75}", "s", 1, *odd_rows()[0][5:]) for i in range(160)])


def test_empty_table(spark):
    out = merkle.tamper_check(frame(spark, []))
    assert out.columns == COLUMNS and out.count() == 0
